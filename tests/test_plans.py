"""Plan shape checks: the watermark predicate and column pruning reach the
Parquet scan, dimension lookups stay equi-joins, dedup limits before the shuffle."""

from pyspark.sql import functions as F

from galaxia.plans import incremental as I
from galaxia.plans import kpis as K
from galaxia.sources import schemas
from test_model import K as KEYS
from test_model import d, orders_df


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_filter_is_pushed_to_parquet(spark, scratch):
    rows = [(KEYS[i], KEYS[0], "x", d(i), None, None, d(i)) for i in range(5)]
    orders_df(spark, rows).write.parquet(scratch + "/orders")
    src = spark.read.schema(schemas.RAW["orders"]).parquet(scratch + "/orders")
    out = I.changed_since(src, "2017-01-03 00:00:00")
    plan = _plan(out)
    assert "PushedFilters: [IsNotNull(last_modified_at), GreaterThan(last_modified_at" in plan
    assert out.count() == 2


def test_kpi_reads_only_needed_columns(spark, scratch):
    fo = spark.createDataFrame([(1, KEYS[1], 1, "delivered", None, None, None, None, None)], schemas.GOLD["fact_orders"])
    dc = spark.createDataFrame([(1, KEYS[0], KEYS[0], "c", "SP", "00001")], schemas.GOLD["dim_customers"])
    fo.write.parquet(scratch + "/fo")
    dc.write.parquet(scratch + "/dc")
    views = {"v_fact_orders": spark.read.parquet(scratch + "/fo"), "v_dim_customers": spark.read.parquet(scratch + "/dc")}
    out = K.orders_by_state(views)
    plan = _plan(out)
    assert "ReadSchema: struct<customer_sk:bigint>" in plan
    assert "ReadSchema: struct<customer_sk:bigint,customer_state:string>" in plan
    assert [tuple(r) for r in out.collect()] == [("SP", 1)]


def test_dedup_limits_before_the_shuffle(spark):
    from galaxia.operators.dedup import keep_latest
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    plan = _plan(keep_latest(df, ["k"], ["ts"]))
    assert plan.count("WindowGroupLimit") >= 2          # partial (map side) + final
    assert "row_number(), 1, Partial" in plan


def test_views_serve_spark_sql(spark):
    from galaxia.plans.views import register_views
    fo = spark.createDataFrame([(1, KEYS[1], 1, "delivered", d().date(), None, None, d(3).date(), d(10).date())],
                               schemas.GOLD["fact_orders"])
    register_views({"fact_orders": fo})
    row = spark.sql("SELECT order_purchase_date, delivered_customer_date, estimated_delivery_date "
                    "FROM v_fact_orders").first()
    assert (row[0], row[1], row[2]) == (d().date(), d(3).date(), d(10).date())
