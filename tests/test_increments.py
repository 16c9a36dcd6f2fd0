"""Increment control: watermarks, reloads, one clock, refreshes, real batches, plans."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from galaxia import catalog as C
from galaxia.operators import merge, stats
from galaxia.plans import incremental as I
from galaxia.plans import silver as SV
from galaxia.sources import driver_tables as D
from galaxia.sources import schemas
from galaxia.sources.io import GoldStore
from test_model import K, P, _sources, d, orders_df

INF = math.inf


@pytest.mark.parametrize("values,median", [
    ([INF, 1.0, 2.0, 3.0, 4.0], 3.0),
    ([-1.7e308, 1.0, 1.7e308], 1.0),
    ([-1.7e308, 1.7e308], 0.0),
    ([INF, INF, INF, 1.0], INF),
    ([-INF, -INF, 5.0, INF], None),      # halfway between -inf and 5 is -inf
    ([7.0] * 10, 7.0),
    ([float("nan"), 2.0], 2.0),
])
def test_medians_of_any_doubles(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert stats.exact_medians(df, ["x"])["x"] == (-INF if median is None else median)


@pytest.mark.parametrize("n", [30_001, 30_002])
def test_medians_with_infinity_among_many(spark, n):
    df = spark.range(n).select(F.when(F.col("id") == n - 1, F.lit(INF)).otherwise(F.col("id").cast("double")).alias("x"))
    assert stats.exact_medians(df, ["x"])["x"] == (n - 1) / 2


def test_watermark_keeps_its_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 0, k),) for k in (1, 2, 3)], "last_modified_at timestamp_ntz")
    mark = df.agg(F.max("last_modified_at")).first()[0]
    assert I.changed_since(df, mark).count() == 0
    assert I.changed_since(df, dt.datetime(2020, 1, 1, 0, 0, 0, 1)).count() == 2


def test_unstamped_rows_belong_to_the_first_load(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2020, 1, 1),)], "last_modified_at timestamp_ntz")
    assert I.changed_since(df, None, "2021-01-01 00:00:00").count() == 2
    assert I.changed_since(df, "2019-01-01 00:00:00").count() == 1
    assert [tuple(r) for r in I.unstamped({"orders": df}).collect()] == [("orders", 1)]


def test_watermark_never_goes_back(spark):
    src = _sources(spark, [(K[0], K[0], 1, "city", "SP", d(), d(9))], [(K[1], K[0], "a", d(), None, None, d(5))])
    control = I.batch_watermarks(src, "2019-01-01 00:00:00")
    late = {**src, "orders": orders_df(spark, [(K[1], K[0], "b", d(), None, None, d(2))])}
    marks = {r["table_name"]: r["max_last_modified_at"] for r in I.advance_watermarks(control, late, "2019-01-02 00:00:00").collect()}
    assert (marks["orders"], marks["customers"]) == (d(5), d(9))


def test_reload_forgets_applied_batches(spark, scratch):
    src = _sources(spark, [(K[0], K[0], 1, "city", "SP", d(), d())], [(K[1], K[0], "a", d(), None, None, d())])
    batch = {"orders": orders_df(spark, [(K[2], K[0], "b", d(1), None, None, d(1))])}
    store = GoldStore(spark, scratch + "/state", buckets=4)
    for _ in range(2):
        I.run_initial(store, src, P, "2019-01-01 00:00:00")
        assert store.read("fact_orders").count() == 1
        store.run_batch(batch, P, "2019-01-02 00:00:00", batch_id=1)
        assert store.read("fact_orders").count() == 2


def test_one_clock_rejects_the_future(spark, scratch):
    src = _sources(spark, [(K[0], K[0], 1, "city", "SP", d(), d())],
                   [(K[1], K[0], "a", d(), None, None, d()), (K[2], K[0], "a", dt.datetime(2050, 1, 1), None, None, d())])
    store = GoldStore(spark, scratch + "/state", buckets=4)
    I.run_initial(store, src, SV.Params(), "2019-01-01 00:00:00", silver_root=scratch + "/silver")
    assert [r["order_id"] for r in store.read("fact_orders").collect()] == [K[1]]
    silver = spark.read.parquet(scratch + "/silver/orders")
    assert [(r["silver_source_table"], r["silver_loaded_date"]) for r in silver.collect()] == [("orders", dt.datetime(2019, 1, 1))]


def test_full_refresh_keeps_surrogate_keys(spark):
    def sellers(rows):
        return spark.createDataFrame([(i, 1, c, "SP", 0.0, 0.0) for i, c in rows], schemas.RAW["sellers"])
    silver = SV.clean_sellers(sellers([("a", "x"), ("c", "x")]))
    from galaxia.plans import gold as G
    dim = G.build_gold({"sellers": silver})["dim_sellers"]
    out = I.refresh_dimension(dim, SV.clean_sellers(sellers([("a", "new"), ("b", "x")])), "dim_sellers")
    assert sorted((r["seller_id"], r["seller_sk"], r["seller_city"]) for r in out.collect()) == [
        ("a", 1, "new"), ("b", 3, "x"), ("c", 2, "x")]


@pytest.mark.parametrize("table", ["dim_customers", *I.FACT_OF.values()])
def test_each_batch_holds_inserts_updates_and_a_null(spark, table):
    inc = C.Increment(spark, SF_ORACLE)
    e = {v: k for k, v in I.FACT_OF.items()}.get(table, "customers")
    keys = schemas.KEYS[e]
    old, new = SV.CLEANERS[e](inc.batch1[e], C.FIXTURE), inc.silver2(e)
    assert old.count() and new.join(old, keys, "left_anti").count() and new.join(old, keys, "left_semi").count()
    if e in ("orders", "order_reviews"):       # columns that a cleaning rule does not fill
        c = {"orders": "order_delivered_customer_date", "order_reviews": "review_comment_title"}[e]
        both = new.select(*keys, F.col(c).alias("n")).join(old.select(*keys, F.col(c).alias("o")), keys)
        assert both.where("n IS NULL AND o IS NOT NULL").count()
    assert D.CUTOFF


def test_small_batch_does_not_move_the_target(spark, scratch):
    spark.range(200_000).select(F.col("id").alias("sk"), F.col("id").cast("string").alias("k"), F.lit("v").alias("v")) \
        .write.parquet(scratch + "/target")
    spark.createDataFrame([("5", None), ("x", "new")], "k string, v string").write.parquet(scratch + "/rows")
    target, rows = spark.read.parquet(scratch + "/target"), spark.read.parquet(scratch + "/rows")
    out = merge.upsert(target, rows, ["k"], ["v"], "sk", start_sk=200_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    assert "Exchange hashpartitioning" not in plan.split("Union")[1].split("FileScan")[0]
    out = out.where("k in ('5', 'x')").collect()
    assert sorted((r["k"], r["sk"], r["v"]) for r in out) == [("5", 5, None), ("x", 200_001, "new")]
    assert merge.upsert(target, rows, ["k"], ["v"], "sk", start_sk=200_000).count() == 200_001


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2), (1, 2, 0)])
def test_upserts_in_any_order_give_one_state(spark, order):
    kind = "k long, sk long, v string, changed_at timestamp_ntz"
    target = spark.createDataFrame([(1, 1, "a", d(2)), (2, 2, "b", None), (3, 3, "c", d(9))], kind)
    t = [spark.createDataFrame(rows, "k long, v string, changed_at timestamp_ntz") for rows in (
        [(1, "a4", d(4)), (2, "b0", None), (3, "c1", d(1)), (4, "x", d(1))],
        [(1, None, d(5)), (2, "b1", d(1)), (4, "y", d(3))],
        [(1, "a3", d(3)), (3, "c2", None), (4, "old", None)])]
    for i in order:
        target = merge.upsert(target, t[i], ["k"], ["v"], "sk")
    got = {r["k"]: (r["v"], r["changed_at"]) for r in target.collect()}
    assert got[2] == ("b1", d(1)) and got[3] == ("c", d(9)) and got[4] == ("y", d(3))
    assert got[1] == (None, d(5))


def test_equal_times_are_ordered_by_content(spark):
    a, b = ([(1, x, d(5))] for x in (None, "same time"))
    start = spark.createDataFrame([(1, 1, "a", d(2))], "k long, sk long, v string, changed_at timestamp_ntz")
    found = []
    for rows in ((a, b), (b, a)):
        now = start
        for r in rows:
            now = merge.upsert(now, spark.createDataFrame(r, "k long, v string, changed_at timestamp_ntz"), ["k"], ["v"], "sk")
        found.append(now.collect())
    assert found[0] == found[1]
