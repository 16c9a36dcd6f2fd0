"""The galaxy schema built from silver.

Dimensions get surrogate keys first; facts then look them up with inner joins
(J1/J2, AQE chooses broadcast vs. shuffle at run time) or test that their order
exists (J3, ``left_semi``).  Fact rows that find no parent are not lost: they
are the *parked* rows (I5) returned beside the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ids import mark_parents
from ..operators.joins import lookup_sk, require_parent
from ..operators.keys import assign_sk
from ..session import materialize
from ..sources import schemas
from ..sources.schemas import conform
from .lazy import Lazy, OnceDict, Shown, packed_tables


def _with_sk(df: DataFrame, table: str, versions: bool = False, reads=None) -> DataFrame:
    sk, keys = schemas.GOLD_KEYS[table]
    schema = schemas.stored(table) if versions else schemas.GOLD[table]
    if reads is not None:
        schema = StructType([f for f in schema if f.name in (sk, *keys, *reads)])
        df = df.select(*[c for c in df.columns if c in schema.names])
    return conform(assign_sk(df, keys, sk), schema)


def _version(silver: DataFrame) -> list:
    """The change time rows are merged by, where the silver table has one."""
    return [F.col("last_modified_at").alias(schemas.VERSION)] if "last_modified_at" in silver.columns else []


def dim_rows(silver: DataFrame, table: str) -> DataFrame:
    """Silver -> dimension columns (no key yet), with the gold types."""
    if table == "dim_customers":
        return silver.select("customer_id", "customer_unique_id", "customer_city", "customer_state",
                             "customer_zip_code_prefix", *_version(silver))
    if table == "dim_sellers":
        return silver.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix",
                             F.col("geolocation_lat").try_cast(schemas.COORD).alias("seller_lat"),
                             F.col("geolocation_lng").try_cast(schemas.COORD).alias("seller_lng"))
    if table == "dim_products":
        cols = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
        return silver.select("product_id", "product_category_name", "product_category_name_english",
                             "product_name_length", "product_description_length", "product_photos_qty",
                             *[F.col(c).try_cast(schemas.MEASURE).alias(c) for c in cols])
    raise KeyError(table)


ORDER_DATES = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"]


def _rows(entity: str, j: DataFrame) -> DataFrame:
    """The gold columns of silver rows whose parents are looked up; T8: times cut to dates."""
    if entity == "orders":
        return j.select("order_id", "customer_sk", "order_status",
                        *[F.col(c).cast("date").alias(c) for c in ORDER_DATES], *_version(j))
    if entity == "order_items":
        return j.select("order_id", "order_item_id", "product_sk", "seller_sk",
                        F.col("shipping_limit_date").cast("date").alias("shipping_limit_date"),
                        "price", "freight_value", *_version(j))
    if entity == "order_payments":
        return j.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value", *_version(j))
    return j.select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        F.col("review_creation_date").cast("date").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("date").alias("review_answer_date"), *_version(j))


def order_rows(silver_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """J1 + T8: customer key looked up, times cut to dates."""
    return _rows("orders", lookup_sk(silver_orders, dim_customers, "customer_id", "customer_sk"))


def item_rows(silver_items: DataFrame, dim_products: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Product and seller keys looked up."""
    j = lookup_sk(lookup_sk(silver_items, dim_products, "product_id", "product_sk"),
                  dim_sellers, "seller_id", "seller_sk")
    return _rows("order_items", j)


def payment_rows(silver_payments: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Payments of orders that reached gold."""
    return _rows("order_payments", require_parent(silver_payments, fact_orders, ["order_id"]))


def review_rows(silver_reviews: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """J3 + T8: reviews of orders that reached gold; the whole comment text is kept."""
    return _rows("order_reviews", require_parent(silver_reviews, fact_orders, ["order_id"]))


FACT_OF = {"orders": "fact_orders", "order_items": "fact_order_items",
           "order_payments": "fact_order_payments", "order_reviews": "fact_order_reviews"}

# Of a landed row these silver columns are not asked for again.
PARKED_ONLY = {"orders": ["customer_id", "created_at"], "order_items": ["product_id", "seller_id", "created_at"],
               "order_payments": ["created_at"], "order_reviews": ["created_at"]}
_HAS_PARENT = "__has_parent"


def looked_up(entity: str, silver: DataFrame, look) -> DataFrame:
    """All silver rows of ``entity`` with the keys of their parents, looked up once for
    the rows that land (:func:`landed`) and those that stay parked (:func:`parked`).
    ``look(table, rows, key)`` gives the parent table."""
    if entity == "orders":
        j = lookup_sk(silver, look("dim_customers", silver, "customer_id"), "customer_id", "customer_sk", how="left")
        j = j.withColumn(_HAS_PARENT, F.col("customer_sk").isNotNull())
    elif entity == "order_items":
        j = lookup_sk(silver, look("dim_products", silver, "product_id"), "product_id", "product_sk", how="left")
        j = lookup_sk(j, look("dim_sellers", silver, "seller_id"), "seller_id", "seller_sk", how="left")
        j = j.withColumn(_HAS_PARENT, F.col("product_sk").isNotNull() & F.col("seller_sk").isNotNull())
    else:
        j = mark_parents(silver, look("fact_orders", silver, "order_id"), ["order_id"], _HAS_PARENT)
        j = j.withColumn(_HAS_PARENT, F.col(_HAS_PARENT).isNotNull())
    return j.withColumns({c: F.when(~F.col(_HAS_PARENT), F.col(c)) for c in PARKED_ONLY[entity] if c in silver.columns})


def landed(entity: str, rows: DataFrame) -> DataFrame:
    """The gold rows of :func:`looked_up` rows that found their parents."""
    return _rows(entity, rows.where(_HAS_PARENT))


def parked(entity: str, rows: DataFrame) -> DataFrame:
    """The silver rows of :func:`looked_up` rows that wait for a parent."""
    return conform(rows.where(~F.col(_HAS_PARENT)), schemas.SILVER[entity])


class GoldTables(OnceDict):
    """Gold tables built on first access, once each (a build writes its key map), with
    packed ids."""

    def __init__(self, silver: dict[str, DataFrame], versions: bool = False, reads: dict | None = None):
        super().__init__()
        self.silver, self.versions, self.reads = packed_tables(silver), versions, reads or {}
        # a state for merges has its fact and its parked rows both read
        self.rows = Lazy({e: (lambda e=e: self._looked_up(e)) for e in FACT_OF})

    def _looked_up(self, e: str) -> DataFrame:
        rows = looked_up(e, self.silver[e], lambda table, src, key: self[table])
        return materialize(rows, f"rows-{e}") if self.versions else rows

    def _with_sk(self, df: DataFrame, t: str) -> DataFrame:
        return _with_sk(df, t, self.versions, self.reads.get(t))

    def build(self, t: str) -> DataFrame:
        s = self.silver
        if t in ("dim_customers", "dim_sellers", "dim_products"):
            e = {"dim_customers": "customers", "dim_sellers": "sellers", "dim_products": "products"}[t]
            df = self._with_sk(dim_rows(s[e], t), t)
        elif self.versions and t in FACT_OF.values():
            e = next(e for e in FACT_OF if FACT_OF[e] == t)
            df = self._with_sk(landed(e, self.rows[e]), t)
        elif t == "fact_orders":
            df = self._with_sk(order_rows(s["orders"], self["dim_customers"]), t)
        elif t == "fact_order_items":
            df = self._with_sk(item_rows(s["order_items"], self["dim_products"], self["dim_sellers"]), t)
        elif t == "fact_order_payments":
            df = self._with_sk(payment_rows(s["order_payments"], self["fact_orders"]), t)
        elif t == "fact_order_reviews":
            df = self._with_sk(review_rows(s["order_reviews"], self["fact_orders"]), t)
        elif t == "dim_date":
            from ..functions.dates import calendar_for
            df = calendar_for([(self["fact_orders"], "order_purchase_timestamp"),
                               (self["fact_order_reviews"], "review_creation_date")])
        elif t in PARKED:
            df = parked(PARKED[t], self.rows[PARKED[t]])
        else:
            raise KeyError(t)
        return df


# parked_<entity>: silver fact rows that did not reach gold (their parent is missing)
PARKED = {f"parked_{e}": e for e in FACT_OF}

GOLD_TABLES = ["dim_customers", "dim_sellers", "dim_products", "fact_orders", "fact_order_items",
               "fact_order_payments", "fact_order_reviews", "dim_date"]


def build_gold(silver: dict[str, DataFrame], spark: SparkSession | None = None, versions: bool = False,
               reads: dict | None = None) -> Shown:
    """Full load (G2-G8, T1).  The returned mapping builds each table on first
    access; ``parked_*`` are the silver fact rows whose parent row is missing.
    ``versions`` keeps the change time with each row, for later merges; ``reads`` names
    the columns that a table needs besides its keys (all, where it names none)."""
    return Shown(GoldTables(silver, versions, reads))
