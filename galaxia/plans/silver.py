"""SV1-SV8: one declarative cleaning spec per table, used by the full load and by
every incremental batch.

Order of every spec (D17): clean columns -> row filters -> keep the newest row
per key -> drop rows whose kept version fails the date-order check (D13) ->
impute medians from the surviving rows.  Each step is a narrow ``select`` /
``where`` except the dedup (a shuffle of hashed keys, and one of the rows whose key
comes again, with a partial ``WindowGroupLimit`` before it) and the median (a few one-column aggregate
passes over a materialised copy).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.dedup import keep_latest
from ..operators.stats import medians
from ..session import materialize
from ..sources import schemas
from ..sources.schemas import conform


@dataclass
class Params:
    """Run parameters: time window of valid events, how medians are computed,
    and optional fixed medians (so a small batch can reuse the published ones)."""
    min_time: str = R.MIN_EVENT_TIME
    now: str = "2100-01-01 00:00:00"
    median_mode: str = "exact"          # "exact" (percentile_cont) or "approx"
    rel_err: float = 0.01
    fixed_medians: dict = field(default_factory=dict)      # always used when given
    fallback_medians: dict = field(default_factory=dict)   # used when a batch has no value
    observed: dict = field(default_factory=dict)           # medians actually applied ("table.col")
    packed: bool = False                # ids come out packed (operators.ids), for tables that are joined next


def _kept(df: DataFrame, rule) -> DataFrame:
    """The rows of ``df`` that pass ``rule``.  The partition id, which is never negative,
    keeps the rule above the columns of ``df``: pushed below, it would compute each again."""
    return df.withColumn("__kept", rule & (F.spark_partition_id() >= 0)).where("__kept").drop("__kept")


def _impute_medians(df: DataFrame, cols: list[str], p: Params, table: str) -> tuple[DataFrame, dict]:
    """C13 with A5/A6: replace NULLs of ``cols`` by each column's median over
    ``df``.  ``df`` is materialised first so the median passes and the final
    projection read the same rows without recomputing the dedup."""
    need = [c for c in cols if f"{table}.{c}" not in p.fixed_medians]
    if need:
        df = materialize(df, f"silver-{table}")
    found = medians(df, need, p.median_mode, p.rel_err) if need else {}
    values = {}
    for c in cols:
        key = f"{table}.{c}"
        v = p.fixed_medians.get(key, found.get(c))
        values[c] = p.fallback_medians.get(key) if v is None else v
        if values[c] is not None:
            p.observed[key] = values[c]
    out = df.withColumns({c: R.impute(c, F.lit(values[c]).cast("double")) for c in cols
                          if values[c] is not None})
    return out, values


def clean_customers(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """SV1."""
    df = _kept(raw.select(
            R.clean_key("customer_id").alias("customer_id"),
            R.clean_key("customer_unique_id").alias("customer_unique_id"),
            R.zip5("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
            R.clean_city("customer_city", R.CITY_MIN_LENGTH).alias("customer_city"),
            R.state_code("customer_state").alias("customer_state"),
            "created_at", "last_modified_at"),
               R.not_blank("customer_id", "customer_unique_id") & R.has_length("customer_id"))
    df = keep_latest(df, ["customer_id"], ["last_modified_at"], pack=p.packed)
    return conform(df, schemas.SILVER["customers"])


def clean_sellers(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """SV3."""
    df = _kept(raw.select(
            R.clean_key("seller_id").alias("seller_id"),
            R.zip5("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
            R.clean_city("seller_city").alias("seller_city"),
            R.state_code("seller_state").alias("seller_state"),
            "geolocation_lat", "geolocation_lng"),
               R.not_blank("seller_id"))
    return conform(keep_latest(df, ["seller_id"], pack=p.packed), schemas.SILVER["sellers"])


def clean_geolocation(centroids: DataFrame, p: Params = Params()) -> DataFrame:
    """SV4: zip to text, one row per zip."""
    df = centroids.select(R.zip5("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"),
                          "geolocation_lat", "geolocation_lng")
    return conform(keep_latest(df, ["geolocation_zip_code_prefix"], pack=p.packed), schemas.SILVER["geolocation"])


PRODUCT_MEDIAN_COLS = ["product_name_length", "product_description_length", "product_weight_g",
                       "product_length_cm", "product_height_cm", "product_width_cm"]


def clean_products(raw: DataFrame, p: Params = Params(), return_medians: bool = False):
    """SV2: category names defaulted, misspelt columns renamed, photo count
    floored at 0, non-positive measures unknown, then medians imputed."""
    df = _kept(raw.select(
            R.clean_key("product_id").alias("product_id"),
            R.clean_category("product_category_name").alias("product_category_name"),
            R.clean_category("product_category_name_english").alias("product_category_name_english"),
            F.col("product_name_lenght").alias("product_name_length"),
            F.col("product_description_lenght").alias("product_description_length"),
            R.floor_at("product_photos_qty", 0.0).alias("product_photos_qty"),
            R.nonpositive_to_null("product_weight_g").alias("product_weight_g"),
            R.nonpositive_to_null("product_length_cm").alias("product_length_cm"),
            R.nonpositive_to_null("product_height_cm").alias("product_height_cm"),
            R.nonpositive_to_null("product_width_cm").alias("product_width_cm")),
               R.not_blank("product_id"))
    df = keep_latest(df, ["product_id"], pack=p.packed)
    df, values = _impute_medians(df, PRODUCT_MEDIAN_COLS, p, "products")
    out = conform(df, schemas.SILVER["products"])
    return (out, values) if return_medians else out


def clean_orders(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """SV8: ids, status, purchase time in range; newest version per order; the
    order is dropped when that version has an event before the purchase."""
    df = _kept(raw.select(
            R.clean_key("order_id").alias("order_id"),
            R.clean_key("customer_id").alias("customer_id"),
            R.clean_category("order_status").alias("order_status"),
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
            "created_at", "last_modified_at"),
               R.not_blank("order_id", "customer_id")
                 & R.in_time_range("order_purchase_timestamp", p.min_time, p.now))
    df = keep_latest(df, ["order_id"], ["last_modified_at", "order_purchase_timestamp"], pack=p.packed)
    df = df.where(~R.before_any("order_purchase_timestamp",
                                ["order_delivered_customer_date", "order_delivered_carrier_date",
                                 "order_approved_at"]))
    return conform(df, schemas.SILVER["orders"])


def clean_order_items(raw: DataFrame, p: Params = Params(), return_medians: bool = False):
    """SV7: ids, shipping time in range (NULL kept), price > 0 else median,
    freight floored at 0."""
    df = _kept(raw.select(
            R.clean_key("order_id").alias("order_id"), "order_item_id",
            R.clean_key("product_id").alias("product_id"),
            R.clean_key("seller_id").alias("seller_id"),
            "shipping_limit_date",
            R.nonpositive_to_null("price").alias("price"),
            R.floor_at("freight_value", 0.0).alias("freight_value"),
            "created_at", "last_modified_at"),
               R.not_blank("order_id", "product_id", "seller_id") & R.not_null("order_item_id")
                 & R.in_time_range("shipping_limit_date", p.min_time, p.now, keep_null=True))
    df = keep_latest(df, ["order_id", "order_item_id"], ["last_modified_at", "shipping_limit_date"], pack=p.packed)
    df, values = _impute_medians(df, ["price"], p, "order_items")
    out = conform(df, schemas.SILVER["order_items"],
                  {"price": R.to_money("price"), "freight_value": R.to_money("freight_value")})
    return (out, values) if return_medians else out


def clean_order_payments(raw: DataFrame, p: Params = Params(), return_medians: bool = False):
    """SV6: type lower-cased with a default, installments at least 1, negative
    values dropped, missing values imputed with the median (D10)."""
    df = _kept(raw.select(
            R.clean_key("order_id").alias("order_id"), "payment_sequential",
            R.payment_type("payment_type").alias("payment_type"),
            R.floor_at("payment_installments", 1).alias("payment_installments"),
            "payment_value", "created_at", "last_modified_at"),
               R.not_blank("order_id") & R.not_null("payment_sequential")
                 & R.at_least("payment_value", 0, keep_null=True))
    df = keep_latest(df, ["order_id", "payment_sequential"], ["last_modified_at"], pack=p.packed)
    df, values = _impute_medians(df, ["payment_value"], p, "order_payments")
    out = conform(df, schemas.SILVER["order_payments"], {"payment_value": R.to_money("payment_value")})
    return (out, values) if return_medians else out


def clean_order_reviews(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """SV5: score 1..5 or NULL, blank comments NULL, creation time in range;
    newest version per review; dropped when answered before creation."""
    df = _kept(raw.select(
            R.clean_key("review_id").alias("review_id"),
            R.clean_key("order_id").alias("order_id"),
            "review_score",
            R.blank_to_null("review_comment_title").alias("review_comment_title"),
            R.blank_to_null("review_comment_message").alias("review_comment_message"),
            "review_creation_date", "review_answer_timestamp", "created_at", "last_modified_at"),
               R.not_blank("review_id", "order_id") & R.in_range_or_null("review_score", 1, 5)
                 & R.in_time_range("review_creation_date", p.min_time, p.now))
    df = keep_latest(df, ["review_id"], ["last_modified_at", "review_creation_date"], pack=p.packed)
    df = df.where(~R.before_any("review_creation_date", ["review_answer_timestamp"]))
    return conform(df, schemas.SILVER["order_reviews"])


CLEANERS = {
    "customers": clean_customers,
    "sellers": clean_sellers,
    "geolocation": clean_geolocation,
    "products": clean_products,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "order_payments": clean_order_payments,
    "order_reviews": clean_order_reviews,
}
