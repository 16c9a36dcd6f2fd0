"""Source preparation as Spark jobs: A1, A2, F10, P7, J6-J8.

The reference prepares its sources with a local pandas process; here the same
operations are distributed DataFrame plans.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ColumnOrName, _c
from .joins import enrich_left, semi_by_keys


def mean_by_key(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """A1: mean of ``cols`` per ``key`` (partial + final hash aggregate)."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def zip_centroids(points: DataFrame) -> DataFrame:
    """A1 on geolocation points: one mean coordinate per zip prefix."""
    return mean_by_key(points, "geolocation_zip_code_prefix", ["geolocation_lat", "geolocation_lng"])


def seller_geo_enrich(sellers: DataFrame, centroids: DataFrame) -> DataFrame:
    """Seller zip -> mean coordinates (left join; the lookup key is dropped)."""
    base = sellers.drop("geolocation_lat", "geolocation_lng")
    return enrich_left(base, centroids, "seller_zip_code_prefix", "geolocation_zip_code_prefix")


def category_translate(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category name -> English name (left join on the category name)."""
    return enrich_left(products.drop("product_category_name_english"), translation,
                       "product_category_name")


def derive_year_quarter(df: DataFrame, ts: ColumnOrName = "order_purchase_timestamp") -> DataFrame:
    """Calendar year and quarter of the purchase time."""
    t = _c(ts)
    return df.withColumns({"year": F.year(t), "quarter": F.quarter(t)})


def slice_by_year_quarter(df: DataFrame, year: int, quarter: int) -> DataFrame:
    """one quarterly cohort.  On a table written with
    ``partitionBy("year", "quarter")`` this prunes to one folder."""
    return df.where((F.col("year") == year) & (F.col("quarter") == quarter))


def cohort_children(cohort_orders: DataFrame, children: DataFrame, key: str = "order_id") -> DataFrame:
    """Child rows of a cohort (semi join on the key, never a collected list)."""
    return semi_by_keys(children, cohort_orders, [key])
