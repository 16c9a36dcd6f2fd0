"""The file stream applies each announced batch once, also across restarts."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from galaxia import catalog as C
from galaxia.operators.ids import packed
from galaxia.plans import incremental as I
from galaxia.session import scratch_root
from galaxia.sources import schemas
from galaxia.sources.io import GoldStore
from galaxia.streaming.increments import MARKER_SCHEMA, publish_changes, stream_increments
from test_model import K, P, _sources, d, orders_df


def test_stream_restart_applies_each_batch_once(spark, scratch):
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "shipped", d(), None, None, d())]
    store = GoldStore(spark, scratch + "/state", buckets=4)
    store.publish_initial(I.initial_load(_sources(spark, c1, o1), P, "2019-01-01 00:00:00"))
    changes, ckpt = scratch + "/changes", scratch + "/ckpt"
    publish_changes(spark, changes, 1, {"orders": orders_df(spark, [(K[2], K[0], "a", d(1), None, None, d(1))])})
    stream_increments(spark, changes, store, P, "2019-01-02 00:00:00", ckpt)
    publish_changes(spark, changes, 2, {"orders": orders_df(spark, [(K[1], K[0], "delivered", d(), None, d(2), d(3))])})
    stream_increments(spark, changes, store, P, "2019-01-03 00:00:00", ckpt)   # restart: only batch 2
    stream_increments(spark, changes, store, P, "2019-01-04 00:00:00", ckpt)   # nothing new
    m = store.manifest()
    assert m["applied"] == [1, 2]
    got = sorted((r["order_id"], r["order_sk"], r["order_status"]) for r in store.read("fact_orders").collect())
    assert got == [(K[1], 1, "delivered"), (K[2], 2, "a")]


def _store(spark, scratch, **more):
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    store = GoldStore(spark, scratch + "/state", buckets=4)
    store.publish_initial(I.initial_load({**_sources(spark, c1, [(K[1], K[0], "shipped", d(), None, None, d(4))]), **more}, P, "2019-01-01 00:00:00"))
    return store


def _sellers(spark, rows):
    return spark.createDataFrame([(i, 1, c, "SP", 0.0, 0.0) for i, c in rows], schemas.RAW["sellers"])


def test_refreshed_tables_flow_through_the_stream(spark, scratch):
    store = _store(spark, scratch, sellers=_sellers(spark, [("a", "x"), ("c", "x")]))
    publish_changes(spark, scratch + "/changes", 1, {"sellers": _sellers(spark, [("a", "new"), ("b", "x")])})
    stream_increments(spark, scratch + "/changes", store, P, "2019-01-02 00:00:00", scratch + "/ckpt")
    got = sorted((r["seller_id"], r["seller_sk"], r["seller_city"]) for r in store.read("dim_sellers").collect())
    assert got == [("a", 1, "new"), ("b", 3, "x"), ("c", 2, "x")]


@pytest.mark.parametrize("entities", [{"orders": 2}, {"orders": 1, "nonsense": 1}, {"order_items": 1}, None])
def test_a_bad_marker_is_not_applied(spark, scratch, entities):
    store, changes = _store(spark, scratch), scratch + "/changes"
    publish_changes(spark, changes, 1, {"orders": orders_df(spark, [(K[2], K[0], "a", d(1), None, None, d(1))])})
    spark.createDataFrame([(1, entities)], MARKER_SCHEMA).coalesce(1).write.mode("overwrite").json(changes + "/_batches")
    with pytest.raises(StreamingQueryException):
        stream_increments(spark, changes, store, P, "2019-01-02 00:00:00", scratch + "/ckpt")
    assert store.manifest()["applied"] == [] and store.read("fact_orders").count() == 1
    with pytest.raises(ValueError):
        publish_changes(spark, changes, 3, {"nonsense": spark.range(1)})


def test_an_older_version_that_arrives_late_changes_nothing(spark, scratch):
    store, changes = _store(spark, scratch), scratch + "/changes"
    late = [(K[1], K[0], "zz", d(), None, None, dt.datetime(1990, 1, 1)), (K[2], K[0], "new", d(), None, None, dt.datetime(1990, 1, 1))]
    publish_changes(spark, changes, 1, {"orders": orders_df(spark, late)})
    stream_increments(spark, changes, store, P, "2019-01-02 00:00:00", scratch + "/ckpt")
    assert sorted((r["order_id"], r["order_status"]) for r in store.read("fact_orders").collect()) == [(K[1], "shipped"), (K[2], "new")]
    assert store.read("fact_orders").columns == schemas.GOLD["fact_orders"].fieldNames()


def test_the_store_shuffles_packed_ids_and_writes_texts(spark, scratch):
    store = GoldStore(spark, scratch + "/state", buckets=4)
    raw = spark.createDataFrame([(K[i], i) for i in range(9)] + [("odd", 9), (None, 10)], "order_id string, n int")
    raw.write.parquet(scratch + "/raw")
    for df in (spark.read.parquet(scratch + "/raw"), packed(spark.read.parquet(scratch + "/raw"))):
        out = store._by_bucket(df, "order_id")
        assert {(r.order_id, r.n, r.bucket) for r in out.collect()} == {
            (r.order_id, r.n, r.b) for r in raw.withColumn("b", F.expr("cast(pmod(xxhash64(order_id), 4) as int)")).collect()}
        tree = out._jdf.queryExecution().optimizedPlan().toString()
        assert tree.index("lower(hex(") < tree.index("RebalancePartitions") < tree.index("unhex(")


def test_stream_queries_leave_no_table_of_the_load_behind(spark):
    root = scratch_root(spark).removeprefix("file:")
    def left():
        return set(os.listdir(root)) if os.path.isdir(root) else set()
    before = left()
    assert C.QUERIES["stream_refresh"](spark, SF_SMALL).count() > 0
    assert left() == before
