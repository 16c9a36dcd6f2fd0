"""Explicit StructTypes for every table at every layer.

Nothing is inferred: each layer boundary is a ``select`` + ``cast`` onto one of
these schemas (see :func:`conform`).  Timestamps carry no zone in the source, so
they are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType,
)

from ..operators.ids import IDS

S, I, L, D, TS, DT, B = (StringType(), IntegerType(), LongType(), DoubleType(),
                          TimestampNTZType(), DateType(), BooleanType())
MONEY = DecimalType(18, 2)
MEASURE = DecimalType(10, 2)
COORD = DecimalType(18, 12)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in
                       ((f + (True,))[:3] for f in fields)])


# --------------------------------------------------------------------------
# Source (raw) tables: the shape the relational source hands over.
# --------------------------------------------------------------------------
RAW = {
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", I),
        ("customer_city", S), ("customer_state", S), ("created_at", TS), ("last_modified_at", TS)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S),
        ("geolocation_lat", D), ("geolocation_lng", D)),
    "products": _schema(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", D),
        ("product_description_lenght", D), ("product_photos_qty", D), ("product_weight_g", D),
        ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D),
        ("product_category_name_english", S)),
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S), ("order_purchase_timestamp", TS),
        ("order_approved_at", TS), ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS), ("order_estimated_delivery_date", TS),
        ("year", I), ("quarter", I), ("created_at", TS), ("last_modified_at", TS)),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", D), ("freight_value", D),
        ("created_at", TS), ("last_modified_at", TS)),
    "order_payments": _schema(
        ("order_id", S), ("payment_sequential", L), ("payment_type", S),
        ("payment_installments", I), ("payment_value", D), ("created_at", TS),
        ("last_modified_at", TS)),
    "order_reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS),
        ("review_answer_timestamp", TS), ("created_at", TS), ("last_modified_at", TS)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", I), ("geolocation_lat", D), ("geolocation_lng", D)),
    "category_translation": _schema(
        ("product_category_name", S), ("product_category_name_english", S)),
}

# Keys of each entity (business keys; the dedup / merge grain).
KEYS = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
}

# --------------------------------------------------------------------------
# Silver: cleaned, typed, one row per key.  Change-tracking columns stay so the
# watermark can be read from silver.
# --------------------------------------------------------------------------
SILVER = {
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S), ("created_at", TS), ("last_modified_at", TS)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S),
        ("geolocation_lat", D), ("geolocation_lng", D)),
    "products": _schema(
        ("product_id", S), ("product_category_name", S), ("product_category_name_english", S),
        ("product_name_length", I), ("product_description_length", I), ("product_photos_qty", I),
        ("product_weight_g", D), ("product_length_cm", D), ("product_height_cm", D),
        ("product_width_cm", D)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D)),
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S), ("order_purchase_timestamp", TS),
        ("order_approved_at", TS), ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS), ("order_estimated_delivery_date", TS),
        ("created_at", TS), ("last_modified_at", TS)),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", MONEY), ("freight_value", MONEY),
        ("created_at", TS), ("last_modified_at", TS)),
    "order_payments": _schema(
        ("order_id", S), ("payment_sequential", L), ("payment_type", S),
        ("payment_installments", I), ("payment_value", MONEY), ("created_at", TS),
        ("last_modified_at", TS)),
    "order_reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS),
        ("review_answer_timestamp", TS), ("created_at", TS), ("last_modified_at", TS)),
}

# --------------------------------------------------------------------------
# Gold: galaxy schema.
# --------------------------------------------------------------------------
GOLD = {
    "dim_customers": _schema(
        ("customer_sk", L), ("customer_id", S), ("customer_unique_id", S), ("customer_city", S),
        ("customer_state", S), ("customer_zip_code_prefix", S)),
    "dim_sellers": _schema(
        ("seller_sk", L), ("seller_id", S), ("seller_city", S), ("seller_state", S),
        ("seller_zip_code_prefix", S), ("seller_lat", COORD), ("seller_lng", COORD)),
    "dim_products": _schema(
        ("product_sk", L), ("product_id", S), ("product_category_name", S),
        ("product_category_name_english", S), ("product_name_length", I),
        ("product_description_length", I), ("product_photos_qty", I),
        ("product_weight_g", MEASURE), ("product_length_cm", MEASURE),
        ("product_height_cm", MEASURE), ("product_width_cm", MEASURE)),
    "fact_orders": _schema(
        ("order_sk", L), ("order_id", S), ("customer_sk", L), ("order_status", S),
        ("order_purchase_timestamp", DT), ("order_approved_at", DT),
        ("order_delivered_carrier_date", DT), ("order_delivered_customer_date", DT),
        ("order_estimated_delivery_date", DT)),
    "fact_order_items": _schema(
        ("order_item_sk", L), ("order_id", S), ("order_item_id", I), ("product_sk", L),
        ("seller_sk", L), ("shipping_limit_date", DT), ("price", MONEY), ("freight_value", MONEY)),
    "fact_order_payments": _schema(
        ("order_payment_sk", L), ("order_id", S), ("payment_sequential", L), ("payment_type", S),
        ("payment_installments", I), ("payment_value", MONEY)),
    "fact_order_reviews": _schema(
        ("order_review_sk", L), ("review_id", S), ("order_id", S), ("review_score", I),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", DT), ("review_answer_date", DT)),
    "dim_date": _schema(
        ("date", DT), ("year", I), ("quarter", I), ("quarter_name", S), ("month", I),
        ("month_name", S), ("month_short", S), ("month_year", S), ("day", I), ("day_name", S),
        ("day_short", S), ("is_weekend", B), ("week_of_year", I)),
}

CONTROL = _schema(("table_name", S), ("max_created_at", TS), ("max_last_modified_at", TS),
                  ("last_load_timestamp", TS))

# Surrogate-key column and business key of every gold table.
GOLD_KEYS = {
    "dim_customers": ("customer_sk", ["customer_id"]),
    "dim_sellers": ("seller_sk", ["seller_id"]),
    "dim_products": ("product_sk", ["product_id"]),
    "fact_orders": ("order_sk", ["order_id"]),
    "fact_order_items": ("order_item_sk", ["order_id", "order_item_id"]),
    "fact_order_payments": ("order_payment_sk", ["order_id", "payment_sequential"]),
    "fact_order_reviews": ("order_review_sk", ["review_id"]),
}


#: The change time a stored gold row was last written with; not part of the published tables.
VERSION = "changed_at"
VERSIONED = ("dim_customers", "fact_orders", "fact_order_items", "fact_order_payments", "fact_order_reviews")


def stored(table: str) -> StructType:
    """The columns a gold table is stored with."""
    return _schema(*[(f.name, f.dataType) for f in GOLD[table].fields], (VERSION, TS)) if table in VERSIONED else GOLD[table]


def conform(df: DataFrame, schema: StructType, extra: dict[str, Column] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: exact column order, ``try_cast`` to each
    declared type (ANSI mode raises on a bad ``cast``).  Missing columns become
    typed NULLs so the boundary never depends on what arrived.  Packed ids stay packed."""
    extra = extra or {}
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in extra:
            c = extra[f.name]
        elif f.name in have:
            c = F.col(f.name)
            if f.name in IDS and f.dataType == S and df.schema[f.name].dataType == BinaryType():
                cols.append(c)
                continue
        else:
            c = F.lit(None)
        cols.append(c.try_cast(f.dataType).alias(f.name) if f.name not in have or
                    df.schema[f.name].dataType != f.dataType or f.name in extra
                    else F.col(f.name))
    return df.select(cols)


def empty(spark, schema: StructType) -> DataFrame:
    """A typed empty table."""
    return spark.createDataFrame([], schema)
