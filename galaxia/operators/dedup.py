"""Keep one row per key, deterministically.

Rows whose key nobody else has need no ranking: a first pass shuffles a hash of each
key and finds the repeated ones.  For the rows of these,
``ROW_NUMBER() ... = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
before the shuffle, so a key that holds a third of all rows is cut down to one
row per map task before it is exchanged.  The order is made total (every
remaining column breaks ties) so the kept row never depends on partitioning.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import ColumnOrName, _c
from .ids import packed, packed_ids, text_ids, unpack_ids
from .joins import hashable, key_filter, key_hashes, mark_hashes, mark_maybe


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[ColumnOrName] = ()) -> list[Column]:
    """``first`` descending, then every other column descending; NULLs last."""
    named = {c for c in first if isinstance(c, str)}
    rest = [c for c in df.columns if c not in keys and c not in named]
    return [_c(c).desc_nulls_last() for c in list(first) + rest]


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A key filter (``joins.key_filter``) of the keys that more than one row of ``df`` has.
    Only the hashes of the keys are shuffled."""
    n = key_hashes(df, keys).groupBy("__h").agg(F.count(F.lit(1)).alias("__n"))
    return key_filter(n.where("__n > 1").select("__h"))


def keep_latest(df: DataFrame, keys: Sequence[str], first: Sequence[ColumnOrName] = (), pack: bool = False) -> DataFrame:
    """One row per ``keys``; the newest by ``first`` wins, ties broken by
    the remaining columns (D3).  Rows whose key no other row can have stay where they
    are; those in question are shuffled and ranked.  ``df`` is read more than once and
    must give the same rows each time.  With ``pack`` the ids come out packed."""
    ids = [] if pack else text_ids(df)
    if not hashable(df, keys):
        return unpack_ids(_ranked(df, keys, first), ids)
    met, alone = _parted(df, mark_hashes(df, repeated(df, keys), keys, "__maybe"))
    return unpack_ids(_ranked(met, keys, first), ids).unionByName(packed(alone) if pack else alone)


def _parted(df: DataFrame, marked: DataFrame) -> list[DataFrame]:
    """The rows of ``marked`` that may meet another one, and the others."""
    return [marked.where(c).select(*df.columns) for c in ("__maybe", "NOT __maybe")]


def _ranked(df: DataFrame, keys: Sequence[str], first: Sequence[ColumnOrName]) -> DataFrame:
    """:func:`keep_latest` by one window over all rows; the ids come out packed."""
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, first))
    return (packed(df).withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def latest_of(few: DataFrame, many: DataFrame, keys: Sequence[str], first: Sequence[ColumnOrName] = ()) -> DataFrame:
    """:func:`keep_latest` of both tables together, where ``many`` holds one row per key
    already: its rows whose key cannot be in ``few`` stay where they are."""
    ids = text_ids(many)
    few = packed(few) if packed_ids(many) else few
    met, alone = _parted(many, mark_maybe(many, few, keys, "__maybe"))
    return unpack_ids(_ranked(few.unionByName(met), keys, first), ids).unionByName(alone)


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """W3, made deterministic: same as :func:`keep_latest` with no preferred column."""
    return keep_latest(df, keys)


def collapsed_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q2: keys that occur more than once, with how many rows dedup removes."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1)
              .withColumn("n_dropped", F.col("n_rows") - 1))
