"""The watermark-driven increment, as DataFrame-to-DataFrame steps.

A *state* is a dict of DataFrames: the seven gold tables, ``parked_<entity>``
(silver fact rows waiting for their parent) and ``control`` (one watermark row
per incremental source table).  :func:`initial_load` makes the first state,
:func:`run_batch` turns a state plus one batch of changed source rows into the
next.  Storage and publishing live in ``sources.io``; the stream in
``streaming``.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.dedup import latest_of
from ..operators.ids import packed
from ..operators.merge import UPDATE_COLS, upsert
from ..session import scratch_scope
from ..sources import schemas
from ..sources.schemas import conform
from . import gold as G
from . import silver as SV
from .lazy import Lazy, Shown, packed_tables

# Source tables that arrive in increments (the others are full refresh).
INCREMENTAL = ["customers", "orders", "order_items", "order_payments", "order_reviews"]

# Sent whole each time; their known keys keep their surrogate key.
REFRESHED = {"sellers": "dim_sellers", "products": "dim_products"}

# The newest-version order of each silver fact (used again when parked rows and
# a new batch meet).
NEWEST_FIRST = {
    "orders": ["last_modified_at", "order_purchase_timestamp"],
    "order_items": ["last_modified_at", "shipping_limit_date"],
    "order_payments": ["last_modified_at"],
    "order_reviews": ["last_modified_at", "review_creation_date"],
}
FACT_OF = G.FACT_OF


def changed_since(source: DataFrame, watermark, upto=None) -> DataFrame:
    """Rows changed after ``watermark`` (all rows when it is None),
    optionally up to and including ``upto``.  A literal comparison on a scan
    column, so it is pushed down to Parquet / JDBC.  A row that was never stamped
    belongs to the first load (no watermark); ``unstamped`` counts such rows."""
    if watermark is None:
        return source if upto is None else source.where(
            (F.col("last_modified_at") <= R.ts_lit(upto)) | F.col("last_modified_at").isNull())
    cond = F.col("last_modified_at") > R.ts_lit(watermark)
    return source.where(cond if upto is None else cond & (F.col("last_modified_at") <= R.ts_lit(upto)))


def unstamped(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows per incremental source without ``last_modified_at``: no later batch sees them."""
    parts = [sources[t].agg(F.lit(t).alias("table_name"), F.count_if(F.col("last_modified_at").isNull()).alias("unstamped_rows"))
             for t in INCREMENTAL if t in sources]
    return reduce(lambda a, b: a.unionByName(b), parts)


def batch_watermarks(changes: dict[str, DataFrame], now) -> DataFrame:
    """One control row per incremental table -- the max ``created_at``
    and ``last_modified_at`` of the extracted rows, stamped with ``now``."""
    parts = [changes[t].agg(F.lit(t).alias("table_name"),
                            F.max("created_at").alias("max_created_at"),
                            F.max("last_modified_at").alias("max_last_modified_at"))
             for t in INCREMENTAL if t in changes]
    one = reduce(lambda a, b: a.unionByName(b), parts)
    return conform(one.withColumn("last_load_timestamp", R.ts_lit(now)), schemas.CONTROL)


def get_watermark(control: DataFrame, table: str):
    """The stored high-water mark of ``table`` (one value)."""
    row = control.where(F.col("table_name") == table).select("max_last_modified_at").first()
    return None if row is None else row[0]


def advance_watermarks(control: DataFrame, changes: dict[str, DataFrame], now) -> DataFrame:
    """New control rows = the batch maxima where they are later; a mark
    never goes back, and a table whose batch is empty keeps its own (only the load
    time moves)."""
    new = batch_watermarks(changes, now)
    j = control.alias("o").join(new.alias("n"), "table_name", "full_outer")
    return conform(j.select(
        "table_name",
        F.greatest("n.max_created_at", "o.max_created_at").alias("max_created_at"),
        F.greatest("n.max_last_modified_at", "o.max_last_modified_at").alias("max_last_modified_at"),
        F.coalesce("n.last_load_timestamp", "o.last_load_timestamp").alias("last_load_timestamp")),
        schemas.CONTROL)


STATE_TABLES = [t for t in G.GOLD_TABLES if t != "dim_date"] + [f"parked_{e}" for e in FACT_OF] + ["control"]


def _persist(df: DataFrame, name: str) -> DataFrame:
    """Looked-up and merged rows are read by several later steps: write them once
    instead of recomputing them."""
    from ..session import materialize
    return materialize(df, name)


def store_silver(sources: dict[str, DataFrame], params: SV.Params, now, root: str) -> dict[str, DataFrame]:
    """The silver layer as stored tables with their load columns."""
    from ..sources.io import silver_stamp, write_table
    params = dataclasses.replace(params, now=str(now))
    out = {}
    for e in SV.CLEANERS:
        if e in sources:
            path = f"{root.rstrip('/')}/{e}"
            write_table(silver_stamp(SV.CLEANERS[e](sources[e], params), e, now), path, mode="overwrite")
            out[e] = next(iter(sources.values())).sparkSession.read.parquet(path)
    return out


def initial_load(sources: dict[str, DataFrame], params: SV.Params, now, persist=_persist, silver=None) -> Shown:
    """Entry 1: clean every source, build gold, park the facts whose parent is
    missing, capture the watermarks.  ``now`` also bounds the valid event times."""
    params = dataclasses.replace(params, now=str(now), packed=True)
    silver = {e: conform(df, schemas.SILVER[e]) for e, df in silver.items()} if silver else Lazy(
        {e: (lambda e=e: SV.CLEANERS[e](sources[e], params)) for e in sources if e in SV.CLEANERS})
    gold = G.build_gold(silver, versions=True).packed
    thunks = {t: (lambda t=t: gold[t]) for t in STATE_TABLES if t != "control"}
    thunks["control"] = lambda: batch_watermarks({e: sources[e] for e in INCREMENTAL if e in sources}, now)
    return Shown(Lazy(thunks))


def merge_dimension(dim: DataFrame, silver_rows: DataFrame, table: str = "dim_customers") -> DataFrame:
    """Upsert cleaned rows into a dimension (existing keys keep their sk)."""
    sk, keys = schemas.GOLD_KEYS[table]
    return upsert(dim, G.dim_rows(silver_rows, table), keys, UPDATE_COLS[table], sk)


def merge_fact(fact: DataFrame, landed: DataFrame, table: str) -> DataFrame:
    """M1b-M1e: upsert landed rows into a fact table."""
    sk, keys = schemas.GOLD_KEYS[table]
    return upsert(fact, landed, keys, UPDATE_COLS[table], sk)


def merge_in_memory(table: str, target: DataFrame, rows: DataFrame) -> DataFrame:
    """The default merge step of :func:`run_batch`: M1 against the whole target,
    written once so a chain of batches does not grow one long lineage."""
    sk, keys = schemas.GOLD_KEYS[table]
    return _persist(upsert(target, rows, keys, UPDATE_COLS[table], sk), f"gold-{table}")


def run_batch(state: dict[str, DataFrame], changes: dict[str, DataFrame], params: SV.Params,
              now, merge=merge_in_memory, persist=_persist, lookup=None) -> Shown:
    """I4 + I5 + I6: clean the batch, merge customers, then each fact in
    dependency order (orders before the facts that need them).  Parked rows of
    the previous state join the batch (newest version per key wins); rows that
    still find no parent stay parked.  Control rows move to the batch maxima.

    ``merge(table, target, rows)`` performs each upsert and returns the whole new
    table; the stored state passes one that touches only the affected buckets.
    ``lookup(table, rows, key, table_df)`` may narrow a parent table to the part
    that can hold the keys of ``rows`` (the store reads only their buckets).  Rows
    and tables have packed ids here; those that the two give back may have texts."""
    params = dataclasses.replace(params, now=str(now), packed=True)
    prev = packed_tables(state)
    silver = Lazy({e: (lambda e=e: SV.CLEANERS[e](changes[e], params))
                   for e in changes if e in INCREMENTAL or e in REFRESHED})
    thunks = {t: (lambda t=t: prev[t]) for t in STATE_TABLES}
    st = Lazy(thunks)
    for e, dim in {"customers": "dim_customers", **REFRESHED}.items():
        thunks[f"rows_{dim}"] = lambda: None     # the batch sends none
        if e in changes:
            thunks[f"rows_{dim}"] = lambda e=e, dim=dim: persist(G.dim_rows(silver[e], dim), f"rows-{dim}")
            thunks[dim] = lambda dim=dim: packed(merge(dim, prev[dim], st[f"rows_{dim}"]))

    def pending(e):   # parked rows + the batch, newest version per key
        if e not in changes:
            return prev[f"parked_{e}"]
        return latest_of(prev[f"parked_{e}"], silver[e], schemas.KEYS[e], NEWEST_FIRST[e])

    def look(table, rows, key):
        full = st[table]                  # the parent is merged first
        return lookup(table, rows, key, full) if lookup else full

    def source(e):   # a narrowed lookup reads the keys before the rows
        return persist(pending(e), f"pending-{e}") if lookup else pending(e)

    rows = Lazy({e: (lambda e=e: persist(G.looked_up(e, source(e), look), f"rows-{e}")) for e in FACT_OF})
    landed = Lazy({e: (lambda e=e: G.landed(e, rows[e])) for e in FACT_OF})
    for e, fact in FACT_OF.items():
        thunks[fact] = lambda e=e, fact=fact: packed(merge(fact, prev[fact], landed[e]))
        thunks[f"parked_{e}"] = lambda e=e: G.parked(e, rows[e])
        thunks[f"landed_{e}"] = lambda e=e: landed[e]
    stamped = {e: changes[e] for e in INCREMENTAL if e in changes}
    if stamped:      # a batch of refreshed tables only moves no mark
        thunks["control"] = lambda: persist(advance_watermarks(prev["control"], stamped, now), "control")
    st.thunks = thunks
    return Shown(st)


def refresh_dimension(dim: DataFrame, silver_rows: DataFrame, table: str) -> DataFrame:
    """Full refresh of a dimension that has no increments (sellers, products): rows
    of known keys take the new values and keep their surrogate key, new keys are
    numbered after the largest, and keys the source no longer has stay, because
    facts point at them."""
    return conform(merge_dimension(dim, silver_rows, table), schemas.GOLD[table])


def slice_changes(sources: dict[str, DataFrame], lo=None, hi=None) -> dict[str, DataFrame]:
    """The rows of each incremental source changed in ``(lo, hi]`` -- how the
    reference replays its history in quarterly batches."""
    return {e: changed_since(df, lo, hi) if e in INCREMENTAL else df for e, df in sources.items()}


def replay(spark: SparkSession, sources: dict[str, DataFrame], cuts: list[str], params: SV.Params,
           now) -> Shown:
    """Initial load of everything up to ``cuts[0]``, then one batch per later
    cut (the last batch takes the rest)."""
    bounds = [None] + list(cuts) + [None]
    state = initial_load(slice_changes(sources, None, bounds[1]), params, now)
    for lo, hi in zip(bounds[1:-1], bounds[2:]):
        batch = {e: changed_since(sources[e], lo, hi) for e in INCREMENTAL if e in sources}
        state = run_batch(state, batch, params, now)
    return state


def published(table: DataFrame) -> DataFrame:
    """A gold table without the change time it is stored with."""
    return table.drop(schemas.VERSION)


def _land_bronze(sources: dict[str, DataFrame], bronze_root: str | None, now, batch_id) -> None:
    """S4 + S5: add each extracted table to bronze, stamped, before cleaning.  A batch
    has a partition of its own, which it replaces when it is run again."""
    if not bronze_root:
        return
    from ..sources.io import bronze_ingest, write_table
    for e, df in sources.items():
        write_table(bronze_ingest(df, e, now), f"{bronze_root.rstrip('/')}/{e}/batch_id={batch_id}", mode="overwrite")


def run_initial(store, sources: dict[str, DataFrame], params: SV.Params, now,
                bronze_root: str | None = None, silver_root: str | None = None) -> dict:
    """Entry 1 end to end: land bronze (optional), clean, store silver (optional),
    build gold, park, capture watermarks, publish to ``store`` -- with the medians
    the load used."""
    _land_bronze(sources, bronze_root, now, 0)
    p = dataclasses.replace(params, observed={})
    with scratch_scope(store.spark, "load"):
        silver = store_silver(sources, p, now, silver_root) if silver_root else None
        return store.publish_initial(initial_load(sources, p, now, silver=silver), medians=p.observed)


def run_increment(store, sources: dict[str, DataFrame], params: SV.Params, now,
                  batch_id=None, bronze_root: str | None = None) -> dict:
    """Entry 2 end to end: read each table's stored watermark, extract the rows
    changed since (pushed down to the source), land them in bronze (optional),
    and apply them as one batch to ``store``."""
    m = store.manifest()
    control = store.read("control", manifest=m)
    marks = {r["table_name"]: r["max_last_modified_at"] for r in control.collect()}  # one row per table
    changes = {e: changed_since(sources[e], marks.get(e)) for e in INCREMENTAL if e in sources}
    changes |= {e: sources[e] for e in REFRESHED if e in sources}
    # without an id of its own the batch is known by the state it goes on from
    _land_bronze(changes, bronze_root, now, m["version"] if batch_id is None else batch_id)
    return store.run_batch(changes, params, now, batch_id=batch_id)
