import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"
LONG = ("the quick fox, und der Hund " * 3000) + "x" * 50_000


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and very long texts, ties, repeated rows, odd characters."""
    texts = [(1, "a b"), (1, "a b"), (2, "a  b"), (3, "ab"), (4, None), (5, ""), (6, " \n\t "), (None, "a b"), (None, None), ((1 << 62) + 1, "large id"),
             (7, LONG), (8, LONG + " "), (9, "Straße naïve 　 日本語 Привет <|endoftext|> é \x1c x\U0001f600y"),
             (10, "mail jo@x.org at 10.0.0.1 or +1 (988) 555-2485, 4111 1111 1111 1111"), (11, "One line that is long enough\n b"),
             (12, "one line that is long enough \nc"), (13, "  ONE LINE that is long enough\n\n"), (14, "it's 12 o'clock\r\n\x0b\x0c#*$%")]
    return [Row(doc_id=i, text=t, lang=(None, "en", "de")[k % 3], source=(None, "a")[k % 2], n_chars=None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def odd_extra(spark, odd_rows):
    """The same with further columns named like the operators' own helpers."""
    from pyspark.sql import functions as F
    return (spark.createDataFrame(odd_rows, SCHEMA)
            .withColumns({c: F.lit(7) for c in ("row", "rk", "h", "kept", "fp", "root", "host", "piece", "recipe", "words", "id", "spans", "Text2")}))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
