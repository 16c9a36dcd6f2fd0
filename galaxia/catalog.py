"""Registered queries over the driver tables: name -> (spark, sf_dir) -> DataFrame.

Each query builds the model from whole driver tables with the library's
operators; ``galaxia.oracle_queries`` holds the DuckDB twin of each one.
"""

from __future__ import annotations

import dataclasses
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import prep
from .plans import kpis as K
from .plans import silver as SV
from .plans import views as VW
from .sources import driver_tables as dt

FIXTURE = SV.Params(min_time=dt.MIN_TIME, now=dt.NOW)


class Model:
    """Lazily built layers of the order model for one driver folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: SV.Params = FIXTURE, reads: dict | None = None):
        from .plans.lazy import Lazy
        self.spark, self.sf_dir, self.params, self.reads = spark, sf_dir, params, reads
        self._raw = Lazy({e: (lambda e=e: dt.raw(spark, sf_dir, e)) for e in dt.SQL})
        self._silver = Lazy({e: (lambda e=e: SV.CLEANERS[e](self.source(e), self.params)) for e in SV.CLEANERS})

    def raw(self, entity: str) -> DataFrame:
        return self._raw[entity]

    def source(self, entity: str) -> DataFrame:
        """The source table as the relational source would hand it over."""
        if entity == "geolocation":
            return prep.zip_centroids(self.raw("geolocation"))
        return self.raw(entity)

    def silver(self, entity: str) -> DataFrame:
        return self._silver[entity]

    @cached_property
    def gold(self):
        from .plans.gold import build_gold
        from .plans.lazy import Lazy

        params = dataclasses.replace(self.params, packed=True)
        silver = Lazy({e: (lambda e=e: SV.CLEANERS[e](self.source(e), params)) for e in SV.CLEANERS})
        return build_gold(silver, self.spark, reads=self.reads)

    def view(self, name: str) -> DataFrame:
        """``v_<gold table>`` or ``dim_date``."""
        t = name[2:] if name.startswith("v_") else name
        return VW.view(self.gold[t], t)

    def packed_view(self, name: str) -> DataFrame:
        """The same with packed ids."""
        t = name[2:] if name.startswith("v_") else name
        return VW.view(self.gold.packed[t], t)


class _Views(dict):
    """The views for KPIs, which join and count ids but never show one: ids stay packed."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, name):
        df = self.model.packed_view(name)
        self[name] = df
        return df



def _silver_query(entity: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Model(spark, sf_dir).silver(entity)
    q.__name__ = f"clean_{entity}"
    return q


QUERIES = {
    "clean_customers": _silver_query("customers"),
    "clean_sellers": _silver_query("sellers"),
    "clean_geolocation": _silver_query("geolocation"),
    "clean_products": _silver_query("products"),
    "clean_orders": _silver_query("orders"),
    "clean_order_items": _silver_query("order_items"),
    "clean_payments": _silver_query("order_payments"),
    "clean_reviews": _silver_query("order_reviews"),
}


def _gold_query(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = Model(spark, sf_dir).gold[table]
        if table == "dim_sellers":   # coordinates shown to 6 decimals
            df = df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("seller_lat", "seller_lng")})
        return df
    q.__name__ = table
    return q


def views_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders view (snake-case names, dates)."""
    return Model(spark, sf_dir).view("v_fact_orders")


def _kpi_query(name, fn):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_Views(Model(spark, sf_dir, reads=K.READS.get(name))))
    q.__name__ = fn.__name__
    return q


QUERIES.update({
    "dim_customers": _gold_query("dim_customers"),
    "dim_sellers": _gold_query("dim_sellers"),
    "dim_products": _gold_query("dim_products"),
    "fact_orders": _gold_query("fact_orders"),
    "fact_items": _gold_query("fact_order_items"),
    "fact_payments": _gold_query("fact_order_payments"),
    "fact_reviews": _gold_query("fact_order_reviews"),
    "dim_date": _gold_query("dim_date"),
    "views_fact_orders": views_fact_orders,
    "parked_orders": _gold_query("parked_orders"),
})
QUERIES.update({name: _kpi_query(name, fn) for name, fn in K.KPIS.items()})


# ------------------------------------------------------------------ merges and increments
class Increment:
    """The driver history split at ``CUTOFF``: an initial load of the rows
    changed up to it, then one batch with the rest."""

    def __init__(self, spark: SparkSession, sf_dir: str, cut: str = dt.CUTOFF):
        from .plans import incremental as I
        self.I, self.m = I, Model(spark, sf_dir)
        ents = ["customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"]
        self.sources = {e: self.m.source(e) for e in ents}
        self.batch1 = I.slice_changes(self.sources, None, cut)
        self.batch2 = {e: I.changed_since(self.sources[e], cut) for e in I.INCREMENTAL}
        self.s1 = I.initial_load(self.batch1, FIXTURE, dt.NOW)
        self.s2 = I.run_batch(self.s1, self.batch2, FIXTURE, dt.NOW)

    def silver2(self, e: str) -> DataFrame:
        return SV.CLEANERS[e](self.batch2[e], FIXTURE)

    def merged(self, fact: str) -> DataFrame:
        """Pure M1: batch rows landed against the initial gold, merged into it."""
        from .operators.ids import shown
        from .plans import gold as G
        s1, I = self.s1.packed, self.I
        e = {v: k for k, v in I.FACT_OF.items()}.get(fact, "customers")
        src = SV.CLEANERS[e](self.batch2[e], dataclasses.replace(FIXTURE, packed=True))
        if fact == "dim_customers":
            return shown(I.merge_dimension(s1["dim_customers"], src))
        landed = {"fact_orders": lambda: G.order_rows(src, s1["dim_customers"]),
                  "fact_order_items": lambda: G.item_rows(src, s1["dim_products"], s1["dim_sellers"]),
                  "fact_order_payments": lambda: G.payment_rows(src, s1["fact_orders"]),
                  "fact_order_reviews": lambda: G.review_rows(src, s1["fact_orders"])}[fact]()
        # the merge reads the landed rows twice
        return shown(I.merge_fact(s1[fact], I._persist(landed, f"landed-{e}"), fact))


def _merge_query(table: str):
    def q(spark, sf_dir):
        inc = Increment(spark, sf_dir)
        return inc.I.published(inc.merged(table))
    q.__name__ = f"merge_{table}"
    return q


def _state_query(table: str, which: str = "s2"):
    def q(spark, sf_dir):
        inc = Increment(spark, sf_dir)
        return inc.I.published(getattr(inc, which)[table])
    q.__name__ = f"{which}_{table}"
    return q


def changed_since_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + I3: source orders changed after the stored watermark."""
    inc = Increment(spark, sf_dir)
    wm = inc.I.get_watermark(inc.s1["control"], "orders")
    return inc.I.changed_since(inc.sources["orders"], wm)


def stamp_changes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: customers of the initial load re-stamped against the full history."""
    from .functions.rules import ts_lit
    from .operators.merge import stamp_changes
    inc = Increment(spark, sf_dir)
    cur = SV.clean_customers(inc.batch1["customers"], FIXTURE)
    new = inc.m.silver("customers").drop("created_at", "last_modified_at")
    return stamp_changes(cur, new, ["customer_id"],
                         ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
                         ts_lit(dt.NOW))


QUERIES.update({
    "merge_customers": _merge_query("dim_customers"),
    "merge_orders": _merge_query("fact_orders"),
    "merge_items": _merge_query("fact_order_items"),
    "merge_payments": _merge_query("fact_order_payments"),
    "merge_reviews": _merge_query("fact_order_reviews"),
    "replay_customers": _state_query("dim_customers"),
    "replay_two_batches": _state_query("fact_orders"),
    "replay_items": _state_query("fact_order_items"),
    "replay_payments": _state_query("fact_order_payments"),
    "replay_reviews": _state_query("fact_order_reviews"),
    "replay_parked_orders": _state_query("parked_orders"),
    "landed_orders": _state_query("landed_orders"),
    "initial_watermarks": _state_query("control", "s1"),
    "advanced_watermark": _state_query("control", "s2"),
    "changed_since": changed_since_query,
    "stamp_changes": stamp_changes_query,
})


# ------------------------------------------------------------------ quality, profiling, preparation
from .functions import rules as R  # noqa: E402
from .operators import dedup as DD  # noqa: E402
from .operators import quality as Q  # noqa: E402
from .operators import stats as ST  # noqa: E402


def reject_report_query(spark, sf_dir):
    """Q1: rows each order rule would drop, over the raw orders."""
    o = Model(spark, sf_dir).raw("orders")
    return Q.reject_report(o, {
        "order_id_missing": R.not_blank("order_id"),
        "customer_id_missing": R.not_blank("customer_id"),
        "purchase_time_out_of_range": R.in_time_range("order_purchase_timestamp", dt.MIN_TIME, dt.NOW),
        "event_before_purchase": ~R.before_any("order_purchase_timestamp", [
            "order_delivered_customer_date", "order_delivered_carrier_date", "order_approved_at"]),
    })


def date_error_report_query(spark, sf_dir):
    """Q3: raw orders by date-order flag."""
    o = Model(spark, sf_dir).raw("orders")
    return Q.date_error_report(o, R.before_any("order_purchase_timestamp", [
        "order_delivered_customer_date", "order_delivered_carrier_date", "order_approved_at"]))


def check_unique_query(spark, sf_dir):
    """Q4: raw order keys sent more than once, the NULL key among them."""
    return Q.check_unique(Model(spark, sf_dir).raw("orders"), ["order_id"])


def check_not_null_query(spark, sf_dir):
    """Q5: NULLs in the columns the source declares NOT NULL (order items)."""
    return Q.check_not_null(Model(spark, sf_dir).raw("order_items"),
                            ["order_id", "order_item_id", "product_id", "seller_id"])


def check_fk_query(spark, sf_dir):
    """Q6: orphans of the six relations, over silver, every table cleaned once.  Keys do
    not depend on the imputed measures, so no median is computed for them."""
    measures = [f"products.{c}" for c in SV.PRODUCT_MEDIAN_COLS] + ["order_items.price", "order_payments.payment_value"]
    params, m = dataclasses.replace(FIXTURE, fixed_medians=dict.fromkeys(measures, 0.0)), Model(spark, sf_dir)
    s = {e: SV.CLEANERS[e](m.source(e), params) for e in SV.CLEANERS if e != "geolocation"}.__getitem__
    return Q.check_fk({
        "orders_customers": (s("orders"), s("customers"), ["customer_id"]),
        "items_orders": (s("order_items"), s("orders"), ["order_id"]),
        "items_products": (s("order_items"), s("products"), ["product_id"]),
        "items_sellers": (s("order_items"), s("sellers"), ["seller_id"]),
        "payments_orders": (s("order_payments"), s("orders"), ["order_id"]),
        "reviews_orders": (s("order_reviews"), s("orders"), ["order_id"]),
    })


def collapsed_duplicates_query(spark, sf_dir):
    """Q2: order-item keys that dedup collapses (cleaned keys)."""
    i = Model(spark, sf_dir).raw("order_items").select(
        R.clean_key("order_id").alias("order_id"), "order_item_id")
    return DD.collapsed_duplicates(i, ["order_id", "order_item_id"])


def dedup_latest_query(spark, sf_dir):
    """Newest raw order-item row per (order_id, order_item_id)."""
    i = Model(spark, sf_dir).raw("order_items")
    return DD.keep_latest(i, ["order_id", "order_item_id"], ["last_modified_at"])


def profile_numeric_query(spark, sf_dir):
    """A4: mean, stddev, min, max of the raw item measures."""
    p = ST.profile_numeric(Model(spark, sf_dir).raw("order_items"), ["price", "freight_value"])
    return p.select("column_name", *[F.round(c, 4).alias(c) for c in ("mean", "stddev", "min", "max")])


def completeness_query(spark, sf_dir):
    """Rows and non-NULL values per column of the raw customers."""
    return ST.completeness(Model(spark, sf_dir).raw("customers"))


def max_text_length_query(spark, sf_dir):
    """Longest value of each raw review text column (whole texts)."""
    return ST.max_text_length(Model(spark, sf_dir).raw("order_reviews"),
                              ["review_id", "order_id", "review_comment_title", "review_comment_message"])


def exact_medians_query(spark, sf_dir):
    """Exact medians of the line-item measures, one row."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    med = ST.exact_medians(li, cols)
    return spark.range(1).select(*[F.lit(med[c]).cast("double").alias(f"median_{c}") for c in cols])


def exact_median_impute_query(spark, sf_dir):
    """A6 + C11 + C13: raw item prices, non-positive or missing -> exact median."""
    i = Model(spark, sf_dir).raw("order_items").select(
        "order_id", "order_item_id", R.nonpositive_to_null("price").alias("price"))
    med = ST.exact_medians(i, ["price"])["price"]
    return i.withColumn("price", R.impute("price", F.lit(med).cast("double")))


def value_counts_query(spark, sf_dir):
    """A2: raw customer states by frequency."""
    return ST.value_counts(Model(spark, sf_dir).raw("customers"), "customer_state")


def zip_centroids_query(spark, sf_dir):
    """A1: mean coordinates per zip prefix."""
    c = prep.zip_centroids(Model(spark, sf_dir).raw("geolocation"))
    return c.select("geolocation_zip_code_prefix",
                    *[F.round(x, 6).alias(x) for x in ("geolocation_lat", "geolocation_lng")])


def seller_geo_enrich_query(spark, sf_dir):
    """Raw sellers with the mean coordinates of their zip prefix."""
    m = Model(spark, sf_dir)
    e = prep.seller_geo_enrich(m.raw("sellers"), prep.zip_centroids(m.raw("geolocation")))
    return e.withColumns({x: F.round(x, 6) for x in ("geolocation_lat", "geolocation_lng")})


def category_translate_query(spark, sf_dir):
    """Cleaned products with the English category name from the lookup."""
    m = Model(spark, sf_dir)
    return prep.category_translate(m.silver("products"), m.raw("category_translation"))


COHORT = (1997, 2)


def cohort_orders_query(spark, sf_dir):
    """P7 + F10: the raw orders of one purchase quarter."""
    o = prep.derive_year_quarter(Model(spark, sf_dir).raw("orders"))
    return prep.slice_by_year_quarter(o, *COHORT)


def cohort_children_query(spark, sf_dir):
    """Raw order items of that quarter's orders."""
    m = Model(spark, sf_dir)
    orders = cohort_orders_query(spark, sf_dir)
    return prep.cohort_children(orders, m.raw("order_items"))


QUERIES.update({
    "reject_report": reject_report_query,
    "date_error_report": date_error_report_query,
    "check_unique": check_unique_query,
    "check_not_null": check_not_null_query,
    "check_fk": check_fk_query,
    "collapsed_duplicates": collapsed_duplicates_query,
    "dedup_latest": dedup_latest_query,
    "profile_numeric": profile_numeric_query,
    "completeness": completeness_query,
    "max_text_length": max_text_length_query,
    "exact_medians": exact_medians_query,
    "exact_median_impute": exact_median_impute_query,
    "value_counts": value_counts_query,
    "zip_centroids": zip_centroids_query,
    "seller_geo_enrich": seller_geo_enrich_query,
    "category_translate": category_translate_query,
    "cohort_orders": cohort_orders_query,
    "cohort_children": cohort_children_query,
})


def late_versions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + I5: after both batches the older one is sent again; its older versions
    change nothing, so the facts are those of the batches in their order."""
    inc = Increment(spark, sf_dir)
    late = {e: inc.batch1[e] for e in inc.I.INCREMENTAL}
    return inc.I.published(inc.I.run_batch(inc.s2, late, FIXTURE, dt.NOW)["fact_orders"])


def _reversed_query(fact: str):
    def q(spark, sf_dir):
        """M1 + I5: the newer batch first, the older one after it; the columns that
        merges update, with their keys, are those of the batches in their order."""
        from .operators.merge import UPDATE_COLS
        from .sources import schemas
        inc = Increment(spark, sf_dir)
        older = {e: inc.batch1[e] for e in inc.I.INCREMENTAL}
        nothing = {e: df.where("false") if e in inc.I.INCREMENTAL else df for e, df in inc.batch1.items()}
        state = inc.I.initial_load(nothing, FIXTURE, dt.NOW)
        for batch in (inc.batch2, older):
            state = inc.I.run_batch(state, batch, FIXTURE, dt.NOW)
        return state[fact].select(*schemas.GOLD_KEYS[fact][1], *UPDATE_COLS[fact])
    return q


def kpis_adjusted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2-K17 by difference: sums of the initial load, adjusted by the batch's images."""
    from .plans import kpi_state as KS
    inc = Increment(spark, sf_dir)
    return KS.long_form(KS.advance(KS.first(inc.s1), inc.s1, inc.s2))


def stream_refresh_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh of the products sent through the stream as a file batch."""
    import uuid

    from .session import ensure_checkpoint_dir, scratch_scope
    from .sources.io import GoldStore
    from .streaming.increments import publish_changes, stream_increments
    inc = Increment(spark, sf_dir)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/galaxia-stream-{uuid.uuid4().hex}"
    store = GoldStore(spark, f"{base}/state", buckets=8)
    with scratch_scope(spark, "load"):   # the store holds all that is read later
        store.publish_initial(inc.I.initial_load({**inc.sources, "products": _earlier(inc.m, "products")}, FIXTURE, dt.NOW))
    publish_changes(spark, f"{base}/changes", 1, {"products": inc.sources["products"]})
    stream_increments(spark, f"{base}/changes", store, FIXTURE, dt.NOW, f"{base}/checkpoint")
    return store.read("dim_products")


QUERIES |= {"late_versions": late_versions_query, "stream_refresh": stream_refresh_query, "kpis_adjusted": kpis_adjusted_query}
QUERIES |= {f"reversed_batches_{k}": _reversed_query(f) for k, f in
            {"orders": "fact_orders", "payments": "fact_order_payments", "reviews": "fact_order_reviews"}.items()}


def stream_replay_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial load published to a store, the rest of the history sent as
    a file batch through the stream, the final fact_orders read back."""
    import uuid

    from .session import ensure_checkpoint_dir, scratch_scope
    from .sources.io import GoldStore
    from .streaming.increments import publish_changes, stream_increments

    inc = Increment(spark, sf_dir)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/galaxia-stream-{uuid.uuid4().hex}"
    store = GoldStore(spark, f"{base}/state", buckets=8)
    with scratch_scope(spark, "load"):   # the store holds all that is read later
        store.publish_initial(inc.s1)
    publish_changes(spark, f"{base}/changes", 1, inc.batch2)
    stream_increments(spark, f"{base}/changes", store, FIXTURE, dt.NOW, f"{base}/checkpoint")
    return store.read("fact_orders")


QUERIES["stream_replay"] = stream_replay_query


# ------------------------------------------------------------------ sources and sinks
def bronze_orders_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders landed in bronze, stamped with a fixed load time."""
    from .sources.io import bronze_ingest
    return bronze_ingest(Model(spark, sf_dir).raw("orders"), "orders", dt.NOW)


def csv_roundtrip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S1: raw customers exported as CSV (into the checkpoint folder) and
    read back with the explicit source schema."""
    import uuid

    from .session import ensure_checkpoint_dir
    from .sources import schemas
    from .sources.io import read_csv, write_csv
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/galaxia-csv-{uuid.uuid4().hex}"
    write_csv(Model(spark, sf_dir).raw("customers"), path)
    return read_csv(spark, path, schemas.RAW["customers"])


def csv_quarantine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers exported as CSV lines, by the length of their name four in nine
    damaged (cut short, one field more, an open quote, a wrong time); rows kept by
    customer and lines put aside by reason."""
    from .sources import schemas
    from .sources.io import read_csv_checked
    raw, path = Model(spark, sf_dir).raw("customers"), _folder(spark, "quarantine")
    cols = [F.col(f.name).cast("string") for f in schemas.RAW["customers"].fields]
    line = F.regexp_replace(F.to_csv(F.struct(*cols)), "[\r\n]", " ")
    kind = F.coalesce(F.length("customer_city"), F.lit(0)) % 9
    raw.select(F.when(kind == 1, F.lit("cut,short")).when(kind == 2, F.concat(line, F.lit(",more")))
               .when(kind == 3, F.concat(F.lit('"'), F.translate(line, '"', "")))
               .when(kind == 4, F.regexp_replace(line, "[^,]*$", "no time")).otherwise(line)).write.text(path)
    good, quarantine = read_csv_checked(spark, path, schemas.RAW["customers"], header=False)
    return (good.groupBy(F.lit("good").alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("customer_id").alias("n_keys"))
            .unionByName(quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("long").alias("n_keys"))))


QUERIES["csv_quarantine"] = csv_quarantine_query
QUERIES["bronze_orders"] = bronze_orders_query
QUERIES["csv_roundtrip"] = csv_roundtrip_query


def default_key_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver rows that carry a default value instead of a real one."""
    m = Model(spark, sf_dir)
    return Q.default_key_rows({
        "customers_zip": (m.silver("customers"), "customer_zip_code_prefix", "00000"),
        "customers_city": (m.silver("customers"), "customer_city", R.UNKNOWN),
        "customers_state": (m.silver("customers"), "customer_state", R.UNKNOWN_STATE),
        "sellers_zip": (m.silver("sellers"), "seller_zip_code_prefix", "00000"),
        "orders_status": (m.silver("orders"), "order_status", R.UNKNOWN),
        "payments_type": (m.silver("order_payments"), "payment_type", R.NOT_DEFINED),
    })


QUERIES["default_key_rows"] = default_key_rows_query


def parked_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What still waits for its parent after the replayed history."""
    from .functions.rules import ts_lit
    s2 = Increment(spark, sf_dir).s2
    return Q.parked_report({e: s2[f"parked_{e}"] for e in
                            ["orders", "order_items", "order_payments", "order_reviews"]}, ts_lit(dt.NOW))


QUERIES["parked_report"] = parked_report_query


# ------------------------------------------------------------------ views, layers, refreshes, controls
def _view_query(name: str):
    def q(spark, sf_dir):
        df = Model(spark, sf_dir).view(name)
        if name == "v_dim_sellers":   # coordinates shown to 6 decimals
            df = df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("seller_lat", "seller_lng")})
        return df
    q.__name__ = name.replace("v_", "views_", 1)
    return q


def _bronze_query(entity: str):
    def q(spark, sf_dir):
        from .sources.io import bronze_ingest
        return bronze_ingest(Model(spark, sf_dir).raw(entity), entity, dt.NOW)
    q.__name__ = f"bronze_{entity}"
    return q


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    import uuid

    from .session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/galaxia-{name}-{uuid.uuid4().hex}"


def _stored_silver_query(entity: str):
    def q(spark, sf_dir):
        """P5 + P6 + S6: the cleaned table stored with its load columns and read back."""
        from .plans.incremental import store_silver
        m = Model(spark, sf_dir)
        return store_silver({entity: m.source(entity)}, FIXTURE, dt.NOW, _folder(spark, "silver"))[entity]
    q.__name__ = f"silver_{entity}"
    return q


def table_roundtrip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, replaced, appended to from a select over
    itself and read back; another one cleared and appended to it (no rows)."""
    from .sources import io, schemas
    raw, base = Model(spark, sf_dir).raw("customers"), _folder(spark, "tables")
    io.write_table(raw, f"{base}/a", mode="append")
    io.write_table(io.read_table(spark, f"{base}/a").select(*raw.columns), f"{base}/b", mode="overwrite")
    io.write_table(io.read_table(spark, f"{base}/a"), f"{base}/b", mode="append")
    io.write_table(raw, f"{base}/c", mode="overwrite")
    io.clear_table(spark, f"{base}/c", schemas.RAW["customers"])
    return io.read_table(spark, f"{base}/b").unionByName(io.read_table(spark, f"{base}/c"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def approx_medians_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: is each approximate median within one per cent of the middle rank?"""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    q = ST.approx_medians(li, _MEASURES, 0.01)
    n = F.count(F.lit(1))
    ok = [((F.count_if(F.col(c) < q[c]) / n <= 0.51) & (F.count_if(F.col(c) <= q[c]) / n >= 0.49)).alias(c) for c in _MEASURES]
    parts = ", ".join(f"'{c}', `{c}`" for c in _MEASURES)
    return li.agg(*ok).selectExpr(f"stack({len(_MEASURES)}, {parts}) as (column_name, within_bound)")


def exact_medians_nonfinite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 over whole line items with infinities among them, over the full range of
    doubles, and over one value with a few others."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    k, p = F.col("l_orderkey"), F.col("l_extendedprice")
    df = li.select(F.when(k % 7 == 0, F.lit(float("inf"))).when(k % 11 == 0, F.lit(float("-inf"))).otherwise(p).alias("infinite"),
                   (F.when(k % 2 == 0, p).otherwise(-p) * F.lit(1e303)).alias("wide"),
                   F.when(k % 3 == 0, p).otherwise(F.lit(5.0)).alias("tied"))
    med = ST.exact_medians(df, df.columns)
    return spark.range(1).select(*[F.lit(med[c]).cast("double").alias(f"median_{c}") for c in df.columns])


def _earlier(m: Model, entity: str) -> DataFrame:
    """An earlier snapshot of a table that is sent whole: fewer rows, one older value."""
    raw = m.source(entity)
    if entity == "products":
        return raw.where(F.col("product_length_cm") <= 25).withColumn("product_category_name", F.lit("old"))
    return raw.where(F.col("geolocation_lat") < 40).withColumn("seller_city", F.lit("old"))


def _refresh_query(entity: str):
    def q(spark, sf_dir):
        """S6 + G1: earlier surrogate keys stay, new keys come after the largest."""
        from .plans import gold as G
        from .plans import incremental as I
        m, table = Model(spark, sf_dir), I.REFRESHED[entity]
        dim = G.build_gold({entity: SV.CLEANERS[entity](_earlier(m, entity), FIXTURE)})[table]
        df = I.refresh_dimension(dim, m.silver(entity), table)
        if entity == "sellers":
            df = df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("seller_lat", "seller_lng")})
        return df
    q.__name__ = f"refresh_{entity}"
    return q


def parked_items_landed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of products that the first load did not have land once a refresh
    brings the products."""
    from .plans import incremental as I
    m = Model(spark, sf_dir)
    ents = ["customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"]
    first = I.initial_load({**{e: m.source(e) for e in ents}, "products": _earlier(m, "products")}, FIXTURE, dt.NOW)
    return I.published(I.run_batch(first, {"products": m.source("products")}, FIXTURE, dt.NOW)["fact_order_items"])


def increment_refetch_none_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + I3: rows that the stored watermarks let through a second time (none)."""
    from functools import reduce
    inc = Increment(spark, sf_dir)
    marks = {r["table_name"]: r["max_last_modified_at"] for r in inc.s2["control"].collect()}
    parts = [inc.I.changed_since(inc.sources[t], marks[t]).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for t in inc.I.INCREMENTAL]
    return reduce(lambda a, b: a.unionByName(b), parts)


def late_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch older than the stored watermarks leaves them where they are."""
    inc = Increment(spark, sf_dir)
    return inc.I.advance_watermarks(inc.s2["control"], {e: inc.batch1[e] for e in inc.I.INCREMENTAL}, dt.NOW)


def unstamped_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows that no watermark can ever select."""
    inc = Increment(spark, sf_dir)
    return inc.I.unstamped(inc.sources)


QUERIES.update({
    **{f"views_{t}": _view_query(f"v_{t}") for t in ("dim_customers", "dim_sellers", "dim_products", "fact_order_items",
                                                     "fact_order_payments", "fact_order_reviews")},
    **{f"bronze_{e}": _bronze_query(e) for e in ("customers", "sellers", "products", "geolocation", "order_items",
                                                 "order_payments", "order_reviews")},
    **{f"silver_{e}": _stored_silver_query(e) for e in SV.CLEANERS},
    "parked_items": _gold_query("parked_order_items"),
    "parked_payments": _gold_query("parked_order_payments"),
    "parked_reviews": _gold_query("parked_order_reviews"),
    "table_roundtrip": table_roundtrip_query,
    "approx_medians": approx_medians_query,
    "exact_medians_nonfinite": exact_medians_nonfinite_query,
    "refresh_products": _refresh_query("products"),
    "refresh_sellers": _refresh_query("sellers"),
    "parked_items_landed": parked_items_landed_query,
    "increment_refetch_none": increment_refetch_none_query,
    "late_batch": late_batch_query,
    "unstamped_rows": unstamped_query,
})
