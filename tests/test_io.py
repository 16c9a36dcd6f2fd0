"""Sources and sinks: CSV with a byte-order mark and quoted line breaks,
bronze stamps, CSV export, clearing a table."""

import os

from pyspark.sql import functions as F

from galaxia.sources import io, schemas
from galaxia.sources.schemas import _schema, S
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

TRANSLATION = _schema(("product_category_name", S), ("product_category_name_english", S))


def test_read_csv_bom_and_multiline(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "wb") as f:
        f.write("﻿product_category_name,product_category_name_english\n".encode("utf-8"))
        f.write('beleza_saude,health_beauty\n"cama_mesa","bed\nbath"\n'.encode("utf-8"))
    rows = io.read_csv(spark, path, TRANSLATION, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("beleza_saude", "health_beauty"), ("cama_mesa", "bed\nbath")]


def test_bronze_stamp(spark):
    df = spark.createDataFrame([("a",)], "x string")
    row = io.bronze_ingest(df, "orders", "2020-01-01 00:00:00").first()
    assert row["Source_Table"] == "orders" and str(row["ingested_at"]) == "2020-01-01 00:00:00"


def test_write_csv_roundtrip_and_clear(spark, scratch):
    df = spark.createDataFrame([("x", "y"), ("a,b", 'q"t')], TRANSLATION)
    io.write_csv(df, scratch + "/out")
    back = io.read_csv(spark, scratch + "/out", TRANSLATION)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    io.write_table(df, scratch + "/tbl", mode="overwrite")
    io.clear_table(spark, scratch + "/tbl", TRANSLATION)
    assert spark.read.parquet(scratch + "/tbl").count() == 0


def test_conform_is_exact_schema(spark):
    df = spark.createDataFrame([("1", "x")], "geolocation_zip_code_prefix string, junk string")
    out = schemas.conform(df, schemas.RAW["geolocation"])
    assert out.schema == schemas.RAW["geolocation"]
    assert out.select(F.col("geolocation_zip_code_prefix")).first()[0] == 1


def test_malformed_lines_are_put_aside(spark, tmp_path):
    from galaxia.sources.io import read_csv_checked
    (tmp_path / "a.csv").write_text('id,__line,n\n1,a,2\n2,"b ""q"", c",\n3,short\n4,d,5,6\n5,"open,7\n\n6,e,x\nno,f,8\n', encoding="utf-8")
    good, bad = read_csv_checked(spark, str(tmp_path), StructType([
        StructField("id", IntegerType()), StructField("__line", StringType()), StructField("n", IntegerType())]))
    assert sorted(map(tuple, good.collect())) == [(1, "a", 2), (2, 'b "q", c', None)]
    rows = bad.collect()
    assert sorted((r["line"], r["reason"]) for r in rows) == [
        ('3,short', "fields"), ('4,d,5,6', "fields"), ('5,"open,7', "fields"), ('6,e,x', "value"), ('no,f,8', "value")]
    assert all(r["file"].endswith("a.csv") for r in rows)
    empty = read_csv_checked(spark, str(tmp_path), good.schema, header=True)[1].where("line = ''")
    assert empty.count() == 0
