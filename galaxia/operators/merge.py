"""M1-M5: keyed upserts and change stamping as DataFrame plans.

Parquet has no MERGE, so an upsert is the target left-joined with the
(one-row-per-key) source, and the source rows of new keys added by a union.  A
literal ``True`` marks matched rows -- a marker, not ``coalesce``, so a NULL in
the source really overwrites (MERGE semantics).  New keys get surrogate keys
after the current maximum (G1).  On stored tables the join is confined to the
hash buckets the batch touches (``sources.io.GoldStore``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import unpack_id
from ..sources.schemas import GOLD, GOLD_KEYS, VERSION
from .ids import join_packed, packed, packed_ids, shown
from .keys import assign_sk, max_sk

_T, _S = "__in_target", "__in_source"

# The columns each MERGE updates when a key matches (M1a-M1e).
UPDATE_COLS = {
    "dim_customers": ["customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"],
    "fact_orders": ["order_status", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date"],
    "fact_order_items": ["product_sk", "seller_sk", "shipping_limit_date", "price", "freight_value"],
    "fact_order_payments": ["payment_type", "payment_installments", "payment_value"],
    "fact_order_reviews": ["review_score", "review_comment_title", "review_comment_message",
                           "review_creation_date", "review_answer_date"],
}


# A full refresh updates every column but the keys.
UPDATE_COLS |= {t: [c for c in GOLD[t].fieldNames() if c not in (GOLD_KEYS[t][0], *GOLD_KEYS[t][1])]
                for t in ("dim_sellers", "dim_products")}


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           sk_col: str | None = None, start_sk: int | None = None) -> DataFrame:
    """M1: MERGE ``source`` into ``target`` on ``keys``.

    * matched: ``update_cols`` take the source value (NULL included); every
      other column keeps the target value (surrogate key included);
    * source only: inserted, with a new surrogate key after the target's max;
    * target only: unchanged.

    When both sides carry the change time (``schemas.VERSION``), a matched row takes
    the source only if that is the newer version: an older one that arrives late
    changes nothing, so batches may be applied in any order.  Versions of the same
    time are ordered by a hash of the updated columns; no time is older than any.

    ``source`` must hold one row per key (run W1 first; a duplicate source key
    would fan the target row out).
    """
    keys = list(keys)
    held_packed = packed_ids(target)
    source = packed(source) if held_packed else shown(source)
    target = packed(target) if held_packed else target
    cols = [c for c in target.columns if c not in keys and c != sk_col]
    src_cols = [c for c in cols if c in source.columns]
    versioned = VERSION in target.columns and VERSION in source.columns
    update_cols = [c for c in update_cols if c in cols] + [VERSION] * versioned
    src = source.select(*keys, *src_cols)
    s = src.select(*keys, *[F.col(c).alias(f"s__{c}") for c in src_cols if c in update_cols], F.lit(True).alias(_S))
    j = join_packed(target, s, keys, "left")
    # the batch is the right side of both joins with the target, so a small one is
    # broadcast and the target stays where it is
    held = join_packed(target.select(*keys), src.select(*keys), keys, "left_semi")
    new = join_packed(src, held, keys, "left_anti")
    if sk_col:
        new = assign_sk(new, keys, sk_col, max_sk(target, sk_col) if start_sk is None else start_sk)
    taken = F.col(_S)
    if versioned:
        mine, theirs = F.col(VERSION), F.col(f"s__{VERSION}")
        content = [c for c in update_cols if c in src_cols and c != VERSION]
        text = lambda name, c: unpack_id(name) if c in held_packed else F.col(name)
        same = F.xxhash64(*[text(f"s__{c}", c) for c in content]) >= F.xxhash64(*[text(c, c) for c in content])
        newer = (theirs > mine) | (mine.isNull() & theirs.isNotNull()) | (theirs.eqNullSafe(mine) & same)
        taken = taken & F.coalesce(newer, F.lit(False))
    kept = j.select(*[F.when(taken, F.col(f"s__{c}") if c in src_cols else F.lit(None)).otherwise(F.col(c)).alias(c)
                      if c in update_cols else F.col(c) for c in target.columns])
    types = {f.name: f.dataType for f in target.schema}
    added = new.select(*[(F.col(c) if c in new.columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns])
    return kept.unionByName(added)


def stamp_changes(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  compare_cols: Sequence[str], now: Column) -> DataFrame:
    """M5 (the source's update triggers): new state of a source table.

    An incoming row that differs from the current one in any ``compare_cols``
    (NULL-safe) gets ``last_modified_at = now`` and keeps ``created_at``; a new
    key gets both stamps; unchanged and untouched rows keep theirs."""
    keys = list(keys)
    cols = [c for c in current.columns if c not in keys]
    cur = current.select(*keys, *[F.col(c).alias(f"c__{c}") for c in cols], F.lit(True).alias(_T))
    inc = incoming.select(*keys, *[F.col(c).alias(f"i__{c}") for c in compare_cols], F.lit(True).alias(_S))
    j = cur.join(inc, keys, "full_outer")
    changed = F.lit(False)
    for c in compare_cols:
        changed = changed | ~F.col(f"c__{c}").eqNullSafe(F.col(f"i__{c}"))
    is_new, is_changed = F.col(_T).isNull(), F.col(_S).isNotNull() & F.col(_T).isNotNull() & changed
    out = [F.col(k) for k in keys]
    for c in cols:
        if c == "created_at":
            out.append(F.when(is_new, now).otherwise(F.col(f"c__{c}")).alias(c))
        elif c == "last_modified_at":
            out.append(F.when(is_new | is_changed, now).otherwise(F.col(f"c__{c}")).alias(c))
        elif c in compare_cols:
            out.append(F.when(is_new | is_changed, F.col(f"i__{c}")).otherwise(F.col(f"c__{c}")).alias(c))
        else:
            out.append(F.col(f"c__{c}").alias(c))
    return j.select(*out).select(*current.columns)
