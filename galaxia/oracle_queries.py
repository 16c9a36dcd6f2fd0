"""DuckDB oracle SQL for every registered query (see ``galaxia.oracle``)."""

from __future__ import annotations

from .oracle import SILVER_COLS, raw_cte, silver_ctes, with_  # noqa: F401


def _silver(entity: str) -> str:
    if entity == "geolocation":
        ctes = [raw_cte("geolocation", "geo_points"),
                """raw_geolocation AS (SELECT geolocation_zip_code_prefix,
                      avg(geolocation_lat) AS geolocation_lat, avg(geolocation_lng) AS geolocation_lng
                   FROM geo_points GROUP BY geolocation_zip_code_prefix)"""]
        ctes += silver_ctes("geolocation", raw="raw_geolocation")
    else:
        ctes = silver_ctes(entity)
    return with_(ctes, f"SELECT {', '.join(SILVER_COLS[entity])} FROM silver_{entity}")


ORACLE = {
    "clean_customers": _silver("customers"),
    "clean_sellers": _silver("sellers"),
    "clean_geolocation": _silver("geolocation"),
    "clean_products": _silver("products"),
    "clean_orders": _silver("orders"),
    "clean_order_items": _silver("order_items"),
    "clean_payments": _silver("order_payments"),
    "clean_reviews": _silver("order_reviews"),
}


from .oracle import gold_ctes, model_ctes, r4  # noqa: E402

_M = model_ctes()


def _m(select: str) -> str:
    return with_(_M, select)


def _ratio(num: str, den: str, d: int = 4) -> str:
    return r4(f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)", d)


_LATE = "delivered_customer_date > estimated_delivery_date"
_DAYS = "CAST(datediff('day', order_purchase_date, delivered_customer_date) AS INTEGER)"

ORACLE.update({
    "dim_customers": _m("SELECT * FROM dim_customers"),
    "dim_sellers": _m("""SELECT seller_sk, seller_id, seller_city, seller_state, seller_zip_code_prefix,
        round(CAST(seller_lat AS DOUBLE), 6) AS seller_lat, round(CAST(seller_lng AS DOUBLE), 6) AS seller_lng
        FROM dim_sellers"""),
    "dim_products": _m("SELECT * FROM dim_products"),
    "fact_orders": _m("SELECT * FROM fact_orders"),
    "fact_items": _m("SELECT * FROM fact_order_items"),
    "fact_payments": _m("SELECT * FROM fact_order_payments"),
    "fact_reviews": _m("SELECT * FROM fact_order_reviews"),
    "dim_date": _m("SELECT * FROM dim_date"),
    "views_fact_orders": _m("SELECT * FROM v_fact_orders"),
    "parked_orders": _m("SELECT * FROM silver_orders WHERE order_id NOT IN (SELECT order_id FROM fact_orders)"),
    "kpi_overview_totals": _m(f"""SELECT i.total_revenue, o.total_orders, c.total_customers,
        {_ratio('i.total_revenue', 'i.orders_with_items', 2)} AS avg_order_value
        FROM (SELECT CAST(sum(price) AS DECIMAL(38,2)) AS total_revenue, count(DISTINCT order_id) AS orders_with_items FROM v_fact_order_items) i,
             (SELECT count(*) AS total_orders FROM v_fact_orders) o,
             (SELECT count(DISTINCT customer_unique_id) AS total_customers FROM v_dim_customers) c"""),
    "kpi_revenue_trend": _m("""SELECT d.year, d.month, CAST(sum(i.price) AS DECIMAL(38,2)) AS revenue, count(DISTINCT i.order_id) AS n_orders
        FROM v_fact_order_items i JOIN v_fact_orders o ON i.order_id = o.order_id
        JOIN dim_date d ON d.date = o.order_purchase_date GROUP BY d.year, d.month"""),
    "kpi_orders_by_status": _m("SELECT order_status, count(*) AS n_orders FROM v_fact_orders GROUP BY order_status"),
    "kpi_revenue_by_category": _m("""SELECT p.product_category_name_english, CAST(sum(i.price) AS DECIMAL(38,2)) AS revenue, count(*) AS n_items
        FROM v_fact_order_items i JOIN v_dim_products p ON i.product_sk = p.product_sk
        GROUP BY p.product_category_name_english"""),
    "kpi_order_totals": _m(f"""SELECT count(*) AS total_orders,
        count(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
        count(*) FILTER (WHERE {_LATE}) AS late_orders,
        {r4(f'avg({_DAYS})')} AS avg_delivery_days FROM v_fact_orders"""),
    "kpi_late_vs_on_time": _m(f"""SELECT CASE WHEN {_LATE} THEN 'late' ELSE 'on_time' END AS delivery_status,
        count(*) AS n_orders FROM v_fact_orders WHERE delivered_customer_date IS NOT NULL GROUP BY 1"""),
    "kpi_orders_by_state": _m("""SELECT c.customer_state, count(*) AS n_orders FROM v_fact_orders o
        JOIN v_dim_customers c ON o.customer_sk = c.customer_sk GROUP BY c.customer_state"""),
    "kpi_delivery_performance": _m(f"""SELECT d.year, d.month, count(*) AS n_delivered,
        {_ratio(f'count(*) FILTER (WHERE {_LATE})', 'count(*)')} AS late_rate,
        {r4(f'avg({_DAYS})')} AS avg_delivery_days
        FROM v_fact_orders o JOIN dim_date d ON d.date = o.order_purchase_date
        WHERE o.delivered_customer_date IS NOT NULL GROUP BY d.year, d.month"""),
    "kpi_payment_totals": _m(f"""SELECT CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_payment,
        {_ratio('sum(payment_value)', 'count(payment_value)')} AS avg_payment,
        count(*) AS n_payments, count(DISTINCT payment_type) AS n_payment_types FROM v_fact_order_payments"""),
    "kpi_payment_trend": _m("""SELECT d.year, d.month, CAST(sum(p.payment_value) AS DECIMAL(38,2)) AS total_payment, count(*) AS n_payments
        FROM v_fact_order_payments p JOIN v_fact_orders o ON p.order_id = o.order_id
        JOIN dim_date d ON d.date = o.order_purchase_date GROUP BY d.year, d.month"""),
    "kpi_payment_type_distribution": _m(f"""SELECT payment_type, count(*) AS n_payments, CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_value,
        {_ratio('count(*)', '(SELECT count(*) FROM v_fact_order_payments)')} AS share,
        {_ratio('sum(payment_value)', 'count(*)')} AS avg_value
        FROM v_fact_order_payments GROUP BY payment_type"""),
    "kpi_installments_analysis": _m(f"""SELECT payment_installments, count(*) AS n_payments,
        CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_value, {_ratio('sum(payment_value)', 'count(*)')} AS avg_value
        FROM v_fact_order_payments GROUP BY payment_installments"""),
    "kpi_review_totals": _m(f"""SELECT count(*) AS n_reviews,
        {_ratio('sum(review_score)', 'count(review_score)')} AS avg_score,
        count(*) FILTER (WHERE review_score = 5) AS n_five_star,
        {_ratio('count(review_answer_date)', 'count(*)')} AS response_rate FROM v_fact_order_reviews"""),
    "kpi_score_trend": _m(f"""SELECT d.year, d.month, count(*) AS n_reviews,
        {_ratio('sum(r.review_score)', 'count(r.review_score)')} AS avg_score
        FROM v_fact_order_reviews r JOIN dim_date d ON d.date = r.review_creation_date GROUP BY d.year, d.month"""),
    "kpi_delivery_vs_review": _m(f"""SELECT o.delivery_days, count(*) AS n_reviews,
        {_ratio('sum(r.review_score)', 'count(r.review_score)')} AS avg_score
        FROM v_fact_order_reviews r JOIN (SELECT order_id, {_DAYS} AS delivery_days FROM v_fact_orders
             WHERE delivered_customer_date IS NOT NULL) o ON r.order_id = o.order_id
        GROUP BY o.delivery_days"""),
    "kpi_five_star_by_state": _m(f"""SELECT c.customer_state, count(*) AS n_reviews,
        {_ratio('count(*) FILTER (WHERE r.review_score = 5)', 'count(r.review_score)')} AS five_star_share
        FROM v_fact_order_reviews r JOIN v_fact_orders o ON r.order_id = o.order_id
        JOIN v_dim_customers c ON o.customer_sk = c.customer_sk GROUP BY c.customer_state"""),
    "kpi_score_by_category": _m(f"""SELECT k.product_category_name_english, count(*) AS n_reviews,
        {_ratio('sum(r.review_score)', 'count(r.review_score)')} AS avg_score
        FROM v_fact_order_reviews r JOIN (SELECT DISTINCT i.order_id, p.product_category_name_english
             FROM v_fact_order_items i JOIN v_dim_products p ON i.product_sk = p.product_sk) k
          ON r.order_id = k.order_id GROUP BY k.product_category_name_english"""),
})


from .oracle import MERGE_UPDATES, MIN, NOW, _dedup, increment_ctes, watermark_sql  # noqa: E402,F401
from .sources.schemas import GOLD_KEYS  # noqa: E402

_I = increment_ctes()


def _i(select: str) -> str:
    return with_(_I, select)


_STAMP_COLS = ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
_changed = " OR ".join(f"c.{x} IS DISTINCT FROM i.{x}" for x in _STAMP_COLS)

ORACLE.update({
    "merge_customers": _i("SELECT * FROM m_dim_customers"),
    "merge_orders": _i("SELECT * FROM m_fact_orders"),
    "merge_items": _i("SELECT * FROM m_fact_order_items"),
    "merge_payments": _i("SELECT * FROM m_fact_order_payments"),
    "merge_reviews": _i("SELECT * FROM m_fact_order_reviews"),
    "replay_customers": _i("SELECT * FROM g2_dim_customers"),
    "replay_two_batches": _i("SELECT * FROM g2_fact_orders"),
    "replay_items": _i("SELECT * FROM g2_fact_order_items"),
    "replay_payments": _i("SELECT * FROM g2_fact_order_payments"),
    "replay_reviews": _i("SELECT * FROM g2_fact_order_reviews"),
    "replay_parked_orders": _i("SELECT * FROM parked2_orders"),
    "landed_orders": _i("SELECT * FROM landed2_orders"),
    "initial_watermarks": _i(watermark_sql("raw1_")),
    "advanced_watermark": _i(f"""SELECT coalesce(n.table_name, o.table_name) AS table_name,
        greatest(n.max_created_at, o.max_created_at) AS max_created_at,
        greatest(n.max_last_modified_at, o.max_last_modified_at) AS max_last_modified_at,
        coalesce(n.last_load_timestamp, o.last_load_timestamp) AS last_load_timestamp
        FROM ({watermark_sql("raw1_")}) o FULL OUTER JOIN ({watermark_sql("raw2_")}) n
        ON o.table_name = n.table_name"""),
    "changed_since": _i("""SELECT * FROM raw_orders
        WHERE last_modified_at > (SELECT max(last_modified_at) FROM raw1_orders)"""),
    "stamp_changes": with_(_I + silver_ctes("customers", raw="raw_customers"), f"""SELECT coalesce(c.customer_id, i.customer_id) AS customer_id,
        {', '.join(f"CASE WHEN c.customer_id IS NULL OR ({_changed}) THEN i.{x} ELSE c.{x} END AS {x}" for x in _STAMP_COLS)},
        CASE WHEN c.customer_id IS NULL THEN TIMESTAMP '{NOW}' ELSE c.created_at END AS created_at,
        CASE WHEN c.customer_id IS NULL OR (i.customer_id IS NOT NULL AND ({_changed}))
             THEN TIMESTAMP '{NOW}' ELSE c.last_modified_at END AS last_modified_at
        FROM silver1_customers c FULL OUTER JOIN silver_customers i ON c.customer_id = i.customer_id"""),
})


# every additive KPI over the gold tables after both batches, as rows of (kpi, grp, metric, value)
_GROUPS = {
    "kpi_revenue_trend": (["year", "month"], ["revenue", "n_orders"]),
    "kpi_orders_by_status": (["order_status"], ["n_orders"]),
    "kpi_revenue_by_category": (["product_category_name_english"], ["revenue", "n_items"]),
    "kpi_order_totals": ([], ["total_orders", "delivered_orders", "late_orders", "avg_delivery_days"]),
    "kpi_late_vs_on_time": (["delivery_status"], ["n_orders"]),
    "kpi_orders_by_state": (["customer_state"], ["n_orders"]),
    "kpi_delivery_performance": (["year", "month"], ["n_delivered", "late_rate", "avg_delivery_days"]),
    "kpi_payment_totals": ([], ["total_payment", "avg_payment", "n_payments", "n_payment_types"]),
    "kpi_payment_trend": (["year", "month"], ["total_payment", "n_payments"]),
    "kpi_payment_type_distribution": (["payment_type"], ["n_payments", "total_value", "share", "avg_value"]),
    "kpi_installments_analysis": (["payment_installments"], ["n_payments", "total_value", "avg_value"]),
    "kpi_review_totals": ([], ["n_reviews", "avg_score", "n_five_star", "response_rate"]),
    "kpi_score_trend": (["year", "month"], ["n_reviews", "avg_score"]),
    "kpi_delivery_vs_review": (["delivery_days"], ["n_reviews", "avg_score"]),
    "kpi_five_star_by_state": (["customer_state"], ["n_reviews", "five_star_share"]),
    "kpi_score_by_category": (["product_category_name_english"], ["n_reviews", "avg_score"]),
}


def _long(kpi: str, groups: list[str], metrics: list[str]) -> tuple[str, str]:
    """The rows of one KPI, and the CTE they read."""
    grp = " || '/' || ".join(f"coalesce(CAST({g} AS VARCHAR), '')" for g in groups) or "''"
    select = ORACLE[kpi].removeprefix(with_(_M, ""))
    return "\nUNION ALL\n".join(f"SELECT '{kpi}' AS kpi, {grp} AS grp, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {kpi}"
                                 for m in metrics), f"{kpi} AS MATERIALIZED ({select})"


_LONG = [_long(k, *v) for k, v in _GROUPS.items()]
_AFTER = [f"{t} AS (SELECT * FROM g2_{t})" for t in GOLD_KEYS] + gold_ctes()[len(GOLD_KEYS):]
ORACLE["kpis_adjusted"] = with_(_I + _AFTER + [cte for _, cte in _LONG], "\nUNION ALL\n".join(q for q, _ in _LONG))


# ------------------------------------------------------------------ quality, profiling, preparation
_BEFORE = ("(coalesce(order_delivered_customer_date < order_purchase_timestamp, false) "
           "OR coalesce(order_delivered_carrier_date < order_purchase_timestamp, false) "
           "OR coalesce(order_approved_at < order_purchase_timestamp, false))")


def _raw(entities, select: str) -> str:
    return with_([raw_cte(e) for e in entities], select)


ORACLE.update({
    "reject_report": _raw(["orders"], f"""SELECT rule, rejected_rows, total_rows FROM (
        SELECT count(*) AS total_rows,
          count(*) FILTER (WHERE NOT coalesce(nullif(trim(order_id), '') IS NOT NULL, false)) AS r0,
          count(*) FILTER (WHERE NOT coalesce(nullif(trim(customer_id), '') IS NOT NULL, false)) AS r1,
          count(*) FILTER (WHERE NOT coalesce(order_purchase_timestamp >= TIMESTAMP '{MIN}'
                                 AND order_purchase_timestamp <= TIMESTAMP '{NOW}', false)) AS r2,
          count(*) FILTER (WHERE {_BEFORE}) AS r3
        FROM raw_orders) t,
        LATERAL (VALUES ('order_id_missing', r0), ('customer_id_missing', r1),
                        ('purchase_time_out_of_range', r2), ('event_before_purchase', r3)) v(rule, rejected_rows)"""),
    "date_error_report": _raw(["orders"], f"""SELECT {_BEFORE} AS date_logic_error, count(*) AS n_rows
        FROM raw_orders GROUP BY 1"""),
    "check_unique": _raw(["orders"], """SELECT order_id, count(*) AS n_rows FROM raw_orders
        GROUP BY order_id HAVING count(*) > 1"""),
    "check_not_null": _raw(["order_items"], """SELECT * FROM (VALUES
        ('order_id', (SELECT count(*) FILTER (WHERE order_id IS NULL) FROM raw_order_items)),
        ('order_item_id', (SELECT count(*) FILTER (WHERE order_item_id IS NULL) FROM raw_order_items)),
        ('product_id', (SELECT count(*) FILTER (WHERE product_id IS NULL) FROM raw_order_items)),
        ('seller_id', (SELECT count(*) FILTER (WHERE seller_id IS NULL) FROM raw_order_items))
        ) v(column_name, null_count)"""),
    "check_fk": with_(_M, """
        SELECT 'orders_customers' AS relation, count(*) AS orphans FROM silver_orders
          WHERE customer_id NOT IN (SELECT customer_id FROM silver_customers)
        UNION ALL SELECT 'items_orders', count(*) FROM silver_order_items
          WHERE order_id NOT IN (SELECT order_id FROM silver_orders)
        UNION ALL SELECT 'items_products', count(*) FROM silver_order_items
          WHERE product_id NOT IN (SELECT product_id FROM silver_products)
        UNION ALL SELECT 'items_sellers', count(*) FROM silver_order_items
          WHERE seller_id NOT IN (SELECT seller_id FROM silver_sellers)
        UNION ALL SELECT 'payments_orders', count(*) FROM silver_order_payments
          WHERE order_id NOT IN (SELECT order_id FROM silver_orders)
        UNION ALL SELECT 'reviews_orders', count(*) FROM silver_order_reviews
          WHERE order_id NOT IN (SELECT order_id FROM silver_orders)"""),
    "collapsed_duplicates": _raw(["order_items"], """SELECT lower(trim(order_id)) AS order_id, order_item_id,
        count(*) AS n_rows, count(*) - 1 AS n_dropped FROM raw_order_items GROUP BY 1, 2 HAVING count(*) > 1"""),
    "dedup_latest": _raw(["order_items"], "SELECT * FROM (" + _dedup(
        "raw_order_items", ["order_id", "order_item_id"], ["last_modified_at"],
        ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
         "freight_value", "created_at", "last_modified_at"]) + ")"),
    "profile_numeric": _raw(["order_items"], f"""
        SELECT 'price' AS column_name, {r4('avg(price)')} AS mean, {r4('stddev_samp(price)')} AS stddev,
               {r4('min(price)')} AS min, {r4('max(price)')} AS max FROM raw_order_items
        UNION ALL
        SELECT 'freight_value', {r4('avg(freight_value)')}, {r4('stddev_samp(freight_value)')},
               {r4('min(freight_value)')}, {r4('max(freight_value)')} FROM raw_order_items"""),
    "completeness": _raw(["customers"], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, "
        f"count(*) - count({c}) AS null_count FROM raw_customers"
        for c in SILVER_COLS["customers"])),
    "max_text_length": _raw(["order_reviews"], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(max(length({c})) AS INTEGER) AS max_length FROM raw_order_reviews"
        for c in ["review_id", "order_id", "review_comment_title", "review_comment_message"])),
    "exact_medians": "SELECT " + ", ".join(
        f"CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS median_{c}"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) + " FROM lineitem",
    "exact_median_impute": _raw(["order_items"], """SELECT order_id, order_item_id,
        coalesce(CASE WHEN price > 0 THEN price END,
                 (SELECT quantile_cont(price, 0.5) FROM raw_order_items WHERE price > 0)) AS price
        FROM raw_order_items"""),
    "value_counts": _raw(["customers"], """SELECT customer_state, count(*) AS count FROM raw_customers
        GROUP BY customer_state"""),
    "zip_centroids": _raw(["geolocation"], """SELECT geolocation_zip_code_prefix,
        round(avg(geolocation_lat), 6) AS geolocation_lat, round(avg(geolocation_lng), 6) AS geolocation_lng
        FROM raw_geolocation GROUP BY 1"""),
    "seller_geo_enrich": _raw(["sellers", "geolocation"], """SELECT s.seller_id, s.seller_zip_code_prefix,
        s.seller_city, s.seller_state, round(g.lat, 6) AS geolocation_lat, round(g.lng, 6) AS geolocation_lng
        FROM raw_sellers s LEFT JOIN (SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat,
             avg(geolocation_lng) AS lng FROM raw_geolocation GROUP BY 1) g
          ON s.seller_zip_code_prefix = g.zip"""),
    "category_translate": with_(silver_ctes("products") + [raw_cte("category_translation")],
        """SELECT p.product_id, p.product_category_name, p.product_name_length, p.product_description_length,
        p.product_photos_qty, p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
        t.product_category_name_english
        FROM silver_products p LEFT JOIN raw_category_translation t
          ON p.product_category_name = t.product_category_name"""),
    "cohort_orders": _raw(["orders"], """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
        order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
        order_estimated_delivery_date, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
        CAST(quarter(order_purchase_timestamp) AS INTEGER) AS quarter, created_at, last_modified_at
        FROM raw_orders WHERE year(order_purchase_timestamp) = 1997 AND quarter(order_purchase_timestamp) = 2"""),
    "cohort_children": _raw(["orders", "order_items"], """SELECT * FROM raw_order_items
        WHERE order_id IN (SELECT order_id FROM raw_orders
            WHERE year(order_purchase_timestamp) = 1997 AND quarter(order_purchase_timestamp) = 2)"""),
})

ORACLE["stream_replay"] = ORACLE["replay_two_batches"]
ORACLE["late_versions"] = ORACLE["replay_two_batches"]
ORACLE |= {f"reversed_batches_{n}": _i(f"SELECT {', '.join([*GOLD_KEYS[t][1], *MERGE_UPDATES[t]])} FROM g2_{t}") for n, t in
           {"orders": "fact_orders", "payments": "fact_order_payments", "reviews": "fact_order_reviews"}.items()}

ORACLE["bronze_orders"] = _raw(["orders"], f"""SELECT *, TIMESTAMP '{NOW}' AS ingested_at,
    'orders' AS Source_Table FROM raw_orders""")
# a CSV field that is empty reads back as NULL, as in the reference's CSV reader
ORACLE["csv_roundtrip"] = _raw(["customers"], """SELECT nullif(customer_id, '') AS customer_id,
    nullif(customer_unique_id, '') AS customer_unique_id, customer_zip_code_prefix,
    nullif(customer_city, '') AS customer_city, nullif(customer_state, '') AS customer_state,
    created_at, last_modified_at FROM raw_customers""")

ORACLE["csv_quarantine"] = _raw(["customers"], """SELECT reason, count(*) AS n_rows,
    CASE WHEN reason = 'good' THEN count(DISTINCT nullif(customer_id, '')) END AS n_keys
    FROM (SELECT customer_id, CASE WHEN coalesce(length(customer_city), 0) % 9 IN (1, 2, 3) THEN 'fields'
          WHEN coalesce(length(customer_city), 0) % 9 = 4 THEN 'value' ELSE 'good' END AS reason FROM raw_customers) t
    GROUP BY reason""")

ORACLE["default_key_rows"] = with_(_M, " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} = '{d}') AS default_rows, "
    f"count(*) AS total_rows FROM {t}" for n, t, c, d in [
        ("customers_zip", "silver_customers", "customer_zip_code_prefix", "00000"),
        ("customers_city", "silver_customers", "customer_city", "unknown"),
        ("customers_state", "silver_customers", "customer_state", "UN"),
        ("sellers_zip", "silver_sellers", "seller_zip_code_prefix", "00000"),
        ("orders_status", "silver_orders", "order_status", "unknown"),
        ("payments_type", "silver_order_payments", "payment_type", "Not Defined")]))

ORACLE["parked_report"] = _i(" UNION ALL ".join(
    f"SELECT '{e}' AS table_name, count(*) AS parked_rows, min(last_modified_at) AS oldest_change, "
    f"max(last_modified_at) AS newest_change, "
    f"CAST(max(datediff('day', CAST(last_modified_at AS DATE), DATE '{NOW[:10]}')) AS INTEGER) AS max_age_days "
    f"FROM parked2_{e}" for e in ["orders", "order_items", "order_payments", "order_reviews"]))


# ------------------------------------------------------------------ views, layers, refreshes, controls
from .oracle import INCR, _landing, _not_in, merge_cte, refresh_ctes  # noqa: E402

for _t in ("dim_customers", "dim_products", "fact_order_items", "fact_order_payments", "fact_order_reviews"):
    ORACLE[f"views_{_t}"] = _m(f"SELECT * FROM v_{_t}")
ORACLE["views_dim_sellers"] = ORACLE["dim_sellers"]
for _e in ("customers", "sellers", "products", "geolocation", "order_items", "order_payments", "order_reviews"):
    ORACLE[f"bronze_{_e}"] = _raw([_e], f"SELECT *, TIMESTAMP '{NOW}' AS ingested_at, '{_e}' AS Source_Table FROM raw_{_e}")
for _e in SILVER_COLS:
    _kind = {"orders": "orders", "order_payments": "payments", "order_reviews": "reviews"}.get(_e, _e)
    ORACLE[f"silver_{_e}"] = (f"SELECT *, TIMESTAMP '{NOW}' AS silver_loaded_date, '{_e}' AS silver_source_table "
                              f"FROM ({ORACLE[f'clean_{_kind}']})")
for _e, _f, _k in (("order_items", "items", ["order_id", "order_item_id"]), ("order_payments", "payments", ["order_id", "payment_sequential"]),
                   ("order_reviews", "reviews", ["review_id"])):
    ORACLE[f"parked_{_f}"] = _m(_not_in(f"silver_{_e}", f"fact_{_e}", _k))

ORACLE["table_roundtrip"] = _raw(["customers"], "SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers")
ORACLE["approx_medians"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) > 0 AS within_bound FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
ORACLE["exact_medians_nonfinite"] = """SELECT
    CAST(quantile_cont(CASE WHEN l_orderkey % 7 = 0 THEN CAST('Infinity' AS DOUBLE)
        WHEN l_orderkey % 11 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE l_extendedprice END, 0.5) AS DOUBLE) AS median_infinite,
    CAST(quantile_cont(CASE WHEN l_orderkey % 2 = 0 THEN l_extendedprice ELSE -l_extendedprice END * 1e303, 0.5) AS DOUBLE) AS median_wide,
    CAST(quantile_cont(CASE WHEN l_orderkey % 3 = 0 THEN l_extendedprice ELSE 5.0 END, 0.5) AS DOUBLE) AS median_tied
    FROM lineitem"""

ORACLE["refresh_products"] = with_(refresh_ctes("products"), "SELECT * FROM g2_dim_products")
ORACLE["stream_refresh"] = ORACLE["refresh_products"]
ORACLE["refresh_sellers"] = with_(refresh_ctes("sellers"), """SELECT * REPLACE (
    round(CAST(seller_lat AS DOUBLE), 6) AS seller_lat, round(CAST(seller_lng AS DOUBLE), 6) AS seller_lng) FROM g2_dim_sellers""")
_landed = [*refresh_ctes("products"), "g2_dim_sellers AS (SELECT * FROM g1_dim_sellers)",
           f"parked1 AS ({_not_in('silver_order_items', 'g1_fact_order_items', ['order_id', 'order_item_id'])})",
           f"landed2 AS ({_landing('order_items', 'parked1', 'g2_')})",
           *merge_cte("g2_fact_order_items", "fact_order_items", "g1_fact_order_items", "landed2")]
ORACLE["parked_items_landed"] = with_(_landed, "SELECT * FROM g2_fact_order_items")
ORACLE["increment_refetch_none"] = _i(" UNION ALL ".join(
    f"SELECT '{e}' AS table_name, count(*) AS n_rows FROM raw_{e} WHERE last_modified_at > (SELECT max(last_modified_at) FROM raw_{e})"
    for e in INCR))
ORACLE["late_batch"] = _i(watermark_sql("raw_"))
ORACLE["unstamped_rows"] = _raw(INCR, " UNION ALL ".join(
    f"SELECT '{e}' AS table_name, count(*) FILTER (last_modified_at IS NULL) AS unstamped_rows FROM raw_{e}" for e in INCR))
