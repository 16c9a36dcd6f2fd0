"""One key holding a third of all rows: results stay whole and right, and the
hot key is not funnelled into one writer."""

import glob

from pyspark.sql import functions as F

from galaxia.operators import dedup, stats
from galaxia.sources import schemas
from galaxia.sources.io import GoldStore

HOT = "h" * 32


def _items(spark, n=30000):
    ids = F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.lpad(F.col("id").cast("string"), 32, "0"))
    return spark.range(n).select(
        F.lit(None).cast("long").alias("order_item_sk"), ids.alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"), F.lit(1).cast("long").alias("product_sk"),
        F.lit(1).cast("long").alias("seller_sk"), F.lit(None).cast("date").alias("shipping_limit_date"),
        F.lit(5).cast("decimal(18,2)").alias("price"), F.lit(1).cast("decimal(18,2)").alias("freight_value"))


def test_dedup_hot_key_keeps_one_newest_row(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("k"), F.col("id").alias("ts"))
    out = dedup.keep_latest(df, ["k"], ["ts"])
    assert out.count() == 20001
    assert out.where(F.col("k") == "hot").first()["ts"] == 29997


def test_store_splits_hot_bucket_over_several_files(spark, scratch):
    store = GoldStore(spark, scratch + "/state", buckets=8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    df = _items(spark).withColumn("order_item_sk", F.col("order_item_id").cast("long") + 1)
    entry = store._write("fact_order_items", schemas.conform(df, schemas.GOLD["fact_order_items"]), 1, {})
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_bucket = spark.range(1).select(store._bucket_of(HOT)).first()[0]
    files = glob.glob(f"{scratch}/state/fact_order_items/v=1-*/bucket={hot_bucket}/*.parquet")
    assert len(files) > 1
    assert entry["max_sk"] == 30000


def test_exact_median_with_a_third_identical(spark):
    df = spark.range(30001).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(
        F.col("id").cast("double")).alias("x"))
    vals = sorted(7.0 if i % 3 == 0 else float(i) for i in range(30001))
    assert stats.exact_medians(df, ["x"])["x"] == vals[15000]
