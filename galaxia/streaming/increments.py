"""Increments arriving as files, applied by a Structured Streaming query.

Each batch of changed source rows is written under
``<changes>/<entity>/batch_id=<n>/`` and then announced by a small marker file
in ``<changes>/_batches/``, which lists its entities and how many rows each has.
Facts and customers arrive as changes, sellers and products whole.  A batch with
an entity that is not known, or with other rows than announced, stops the query
before anything is applied; it is not marked, so it is tried again on restart.
The stream reads the markers; ``foreachBatch``
loads the announced batches (partition-pruned reads) and applies them to the
stored state with :meth:`GoldStore.run_batch`.  The query's checkpoint records
which markers were consumed, and the store's manifest records which batch ids
were applied, so a restarted query neither loses nor doubles a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.incremental import INCREMENTAL, REFRESHED
from ..sources import schemas
from ..sources.io import GoldStore

MARKER_SCHEMA = "batch_id long, entities map<string,long>"
ENTITIES = [*INCREMENTAL, *REFRESHED]


def publish_changes(spark: SparkSession, changes_root: str, batch_id: int,
                    changes: dict[str, DataFrame]) -> None:
    """Producer side: write one batch of changed rows, then its marker.  Writing a
    batch again replaces its rows."""
    root = changes_root.rstrip("/")
    if unknown := set(changes) - set(ENTITIES):
        raise ValueError(f"batch {batch_id}: no such entity: {sorted(unknown)}")
    rows = {}
    for e, df in changes.items():
        path = f"{root}/{e}/batch_id={batch_id}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        rows[e] = spark.read.parquet(path).count()
    marker = spark.createDataFrame([(batch_id, rows)], MARKER_SCHEMA)
    marker.coalesce(1).write.mode("append").json(f"{root}/_batches")


class BadBatch(ValueError):
    """A marker names an entity that is not known, or other rows than there are."""


def _load_batch(spark: SparkSession, root: str, batch_id: int, entities: dict[str, int] | None) -> dict[str, DataFrame]:
    """The announced tables, each checked against its marker."""
    if not entities:
        raise BadBatch(f"batch {batch_id}: its marker lists no entities")
    if unknown := set(entities) - set(ENTITIES):
        raise BadBatch(f"batch {batch_id}: no such entity: {sorted(unknown)}")
    out = {}
    for e, n in entities.items():
        # an announced table that is not there fails the read
        df = spark.read.schema(schemas.RAW[e]).parquet(f"{root}/{e}/batch_id={batch_id}")
        if (found := df.count()) != n:
            raise BadBatch(f"batch {batch_id}: {e} has {found} rows, its marker says {n}")
        out[e] = df
    return out


def stream_increments(spark: SparkSession, changes_root: str, store: GoldStore, params, now,
                      checkpoint: str, available_now: bool = True):
    """Start the stream of batch markers; each micro-batch applies its batches
    in id order.  With ``available_now`` the query processes what is there
    and stops (returns after it finished)."""
    root = changes_root.rstrip("/")
    markers = spark.readStream.schema(MARKER_SCHEMA).json(f"{root}/_batches")

    def apply(marker_df: DataFrame, epoch_id: int) -> None:
        # marker rows are one per announced batch, the last one counting: a handful per micro-batch
        found = {r["batch_id"]: r["entities"] for r in marker_df.collect()}
        for bid in sorted(found):
            if bid not in store.manifest()["applied"]:
                store.run_batch(_load_batch(spark, root, bid, found[bid]), params, now, batch_id=bid)

    writer = markers.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
