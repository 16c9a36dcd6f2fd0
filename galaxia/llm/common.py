"""Column helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a regular-expression class and as its complement.
WS = r"[\x20\x09-\x0D]"
NON_WS = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a NULL id is in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1).cast("long"))


def map_documents(df: DataFrame, function, fields: str) -> DataFrame:
    """``mapInPandas`` to doc_id and ``fields``.  The id is text on its way, as pandas
    would make a double of a whole number that may be NULL."""
    kind = df.schema["doc_id"].dataType
    found = df.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(function, f"doc_id string, {fields}")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def slices(batches: Iterator[pd.DataFrame], column: str, size: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Batches cut into runs of rows with about so many characters or bytes in a column."""
    for b in batches:
        cuts = np.flatnonzero(np.diff(np.cumsum(b[column].str.len().to_numpy()) // size)) + 1
        yield from (b.iloc[i] for i in np.split(np.arange(len(b)), cuts) if len(i))


def lowest_hashes(key: Column, distinct: int, size: int) -> Column:
    """Rows whose 64-bit hash ``key`` is in the lowest share that holds about ``size``
    of so many distinct ones.  A sample is drawn by this filter, as a sorted limit
    would send that many rows of every task to the driver."""
    share = min(1.0, size / max(distinct, 1))
    return key <= F.lit(min(int(share * 2.0**64) - 2**63, 2**63 - 1))


def packed(docs: DataFrame) -> DataFrame:
    """Every row as one struct column ``row`` with its content key ``rk``: helper
    columns added beside it can never clash with the table's own names."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), F.col("doc_id").alias("doc_id"), text_of().alias("text"),
                       F.xxhash64(F.to_json(row), F.lit(1)).alias("rk"))
