"""Ids travel packed: a shuffle carries 17 bytes of a 32-digit id, and joins, windows and
sorts on the packed column see the order and the equality of the texts.

Tables that are looked up, merged and written one after another hold their ids packed all
the way (:func:`packed`): every operator takes such a table as it is and gives one back.
They are text again (:func:`shown`) where a table leaves the library."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import pack_id, pack_key, unpack_id, unpack_key

# The id columns of every layer (business keys and references to them).
IDS = ("customer_id", "customer_unique_id", "seller_id", "product_id", "order_id", "review_id")


def text_ids(*dfs: DataFrame) -> list[str]:
    """The id columns that every table which has them holds as text."""
    types = [dict(df.dtypes) for df in dfs]
    return [c for c in IDS if any(c in t for t in types) and all(t.get(c, "string") == "string" for t in types)]


def pack_ids(df: DataFrame, ids: Iterable[str], pack=pack_id) -> DataFrame:
    return df.withColumns({c: pack(c) for c in ids if c in df.columns})


def unpack_ids(df: DataFrame, ids: Iterable[str], unpack=unpack_id) -> DataFrame:
    return df.withColumns({c: unpack(c) for c in ids if c in df.columns})


def packed_ids(df: DataFrame) -> list[str]:
    """The id columns that ``df`` holds packed."""
    types = dict(df.dtypes)
    return [c for c in IDS if types.get(c) == "binary"]


def packed(df: DataFrame) -> DataFrame:
    """``df`` with every id packed, also those that are already."""
    return pack_ids(df, text_ids(df))


def shown(df: DataFrame) -> DataFrame:
    """``df`` with every id as text."""
    return unpack_ids(df, packed_ids(df))


def alike(df: DataFrame, other: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` with those ids packed that ``other`` holds packed."""
    held = packed_ids(other)
    return pack_ids(df, [c for c in text_ids(df) if c in held and c in columns])


def join_packed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left.join(right, keys, how)`` with the ids of both sides packed on the way; ids
    that ``left`` holds packed stay so."""
    plain = text_ids(left)
    left, right = alike(left, right, keys), alike(right, left, keys)
    ids = text_ids(left, right)
    j = pack_ids(left, ids, pack_key).join(pack_ids(right, ids, pack_key), list(keys), how)
    mixed = [c for c in plain if c in packed_ids(left)]
    return unpack_ids(unpack_ids(j, ids, unpack_key), mixed)


def mark_parents(child: DataFrame, parent: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Every row of ``child``; ``flag`` is true where ``parent`` has its key and NULL
    elsewhere.  A key that the parent holds twice counts once."""
    parent = parent.select(*keys)
    ids = text_ids(alike(child, parent, keys), alike(parent, child, keys))
    held = pack_ids(alike(parent, child, keys), ids, pack_key).distinct().withColumn(flag, F.lit(True))
    return unpack_ids(join_packed(pack_ids(child, ids, pack_key), held, keys, "left"), ids, unpack_key)


def packed_view(df: DataFrame) -> DataFrame:
    """``df`` with packed ids, for joins and counts that end without them."""
    return pack_ids(df, text_ids(df), pack_key)
