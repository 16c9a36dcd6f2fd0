"""Op 11 against a word-by-word comparison, with small blocks and odd rows."""

import re
import zlib
from collections import Counter

import pytest

from conftest import SF_SMALL as SF
from galaxia.llm import queries, spelling


def corpus_counts(rows):
    found = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(counts):
    near, words = {w: [] for w in counts}, sorted(counts)
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for size in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [x for x in by_length.get(size, []) if x != w and one_edit(w, x)]
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), form[w] and counts[form[w]]))
    return rows


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_query_equals_comparing_all_words(spark):
    got = queries.op11_spelling_variants(spark, SF)
    assert got.columns == COLUMNS
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == expected(corpus_counts(spark.read.parquet(f"{SF}/documents.parquet").collect()))


@pytest.mark.parametrize("block_bytes", [7, 60])
def test_any_block_size_gives_the_same(spark, block_bytes):
    words = ["spell", "spelt", "spells", "speells", "pells", "spéll", "lleps", "shell", "shells", "shelf", "aaaaa", "aaaaaa", "aaaaaaa", "aaaaab", "x" * 3000, "x" * 2999 + "y", "x" * 3001]
    counts = {w: (i * 7) % 11 + 1 for i, w in enumerate(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling.spelling_variants(df, block_bytes).select(*COLUMNS).collect()} == expected(counts)


def test_odd_rows(spark, odd, odd_extra, odd_rows, none):
    want = corpus_counts(odd_rows)
    for df in (odd, odd_extra):
        assert {r.word: r.n for r in spelling.corpus_words(df).collect()} == want
    assert spelling.spelling_variants(spelling.corpus_words(none)).count() == 0


def test_chains_of_forms_end_at_the_last(spark):
    words = ["a" * (5 + i) for i in range(20)]
    df = spark.createDataFrame([(w, 2 ** i) for i, w in enumerate(words)], "word string, n long")
    assert {r.root for r in spelling.spelling_variants(df).collect()} == {words[-1]}
