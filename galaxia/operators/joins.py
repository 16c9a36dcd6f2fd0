"""The equi-joins of the model.

Dimension lookups are plain inner joins; Catalyst/AQE pick a broadcast hash join
when the dimension is small at run time and a shuffle join otherwise -- nothing
here forces a broadcast of a side whose size grows with the data.  Existence
tests are ``left_semi`` / ``left_anti`` so a duplicated parent cannot fan out.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import join_packed


def lookup_sk(fact: DataFrame, dim: DataFrame, bk: str, sk: str, fact_key: str | None = None, how: str = "inner") -> DataFrame:
    """Business key -> surrogate key; fact rows without a dimension row are dropped
    (or, with ``how`` "left", have no surrogate key)."""
    fact_key = fact_key or bk
    d = dim.select(F.col(bk).alias(fact_key), sk)
    return join_packed(fact, d, [fact_key], how)


def require_parent(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep child rows whose key exists in ``parent``."""
    return join_packed(child, parent.select(*keys), keys, "left_semi")


def not_in(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose key is absent from ``parent``."""
    return join_packed(child, parent.select(*keys), keys, "left_anti")


def enrich_left(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Left join a lookup; the lookup's key column is dropped."""
    right_key = right_key or left_key
    if right_key == left_key:
        return df.join(lookup, left_key, "left")
    lk = lookup.withColumnRenamed(right_key, "__rk")
    return df.join(lk, F.col(left_key) == F.col("__rk"), "left").drop("__rk")


def semi_by_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J8 (``isin(series)``): rows whose key is in another table -- a semi join,
    never a collected list.  Rows whose key cannot be there are left out before they
    are shuffled, which pays where few rows have their key there."""
    return join_packed(_maybe_held(df, keys_df, keys), keys_df.select(*keys), keys, "left_semi")


#: Rows of the key filter and words of 64 bits in each: 32 MB of bits, however many keys there are.
FILTER_ROWS, FILTER_WORDS = 1 << 19, 8
# Types whose equal values have equal hashes.
_HASHED = {"string", "binary", "int", "bigint", "date"}


def hashable(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether rows with the same ``keys`` have the same hash."""
    types = dict(df.dtypes)
    return all(types[k] in _HASHED for k in keys)


def key_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``__h``: a hash of 40 bits of each row's key."""
    return df.select(_hash(keys).alias("__h"))


def _hash(keys: Sequence[str]):
    return F.xxhash64(*[F.col(k) for k in keys]).bitwiseAND(F.lit((1 << 40) - 1))


def mark_maybe(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Every row of ``df``; ``flag`` is false only where its key is not in ``keys_df``:
    it is true where the key (NULL is one too) sets a bit that a key there sets, and
    everywhere if the keys are of different types.  The filter has at most ``FILTER_ROWS`` rows, so it is broadcast
    at any size; the more keys there are, the more others it lets through."""
    types, others = dict(df.dtypes), dict(keys_df.dtypes)
    if any(types[k] != others[k] for k in keys) or not hashable(df, keys):
        return df.withColumn(flag, F.lit(True))
    return mark_hashes(df, key_filter(key_hashes(keys_df, keys)), keys, flag)


def _placed(df: DataFrame) -> DataFrame:
    """The filter's row, word and bit of ``__h``."""
    return df.withColumns({"__row": F.pmod("__h", F.lit(FILTER_ROWS)), "__word": F.expr(f"(__h >> 25) & {FILTER_WORDS - 1}"),
                           "__bit": F.expr("shiftleft(1L, cast((__h >> 19) & 63 as int))")})


def key_filter(hashes: DataFrame) -> DataFrame:
    """The bits that the :func:`key_hashes` set."""
    bits = [F.bit_or(F.when(F.col("__word") == i, F.col("__bit")).otherwise(F.lit(0))).alias(f"__bits{i}") for i in range(FILTER_WORDS)]
    return _placed(hashes).groupBy("__row").agg(*bits)


def mark_hashes(df: DataFrame, held: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Every row of ``df``; ``flag`` is true where its key sets a bit of the filter ``held``."""
    word = " ".join(f"WHEN {i} THEN __bits{i}" for i in range(FILTER_WORDS))
    hit = F.coalesce(F.expr(f"((CASE __word {word} END) & __bit) != 0"), F.lit(False))
    probed = _placed(df.withColumn("__h", _hash(keys)))
    return (probed.join(F.broadcast(held), "__row", "left").select(*df.columns, hit.alias(flag)))


def _maybe_held(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key may be in ``keys_df``."""
    return mark_maybe(df.dropna(subset=list(keys)), keys_df, keys, "__maybe").where("__maybe").drop("__maybe")
