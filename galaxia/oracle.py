"""Independent DuckDB formulations of the registered queries (the correctness
oracle).  The raw fixtures are shared text (see ``sources.driver_tables``);
everything after them -- cleaning, dedup, medians, keys, joins, merges,
reports -- is written here a second time in plain SQL.
"""

from __future__ import annotations

from .functions import rules as R
from .sources import driver_tables as dt

MIN, NOW, CUT = dt.MIN_TIME, dt.NOW, dt.CUTOFF


def raw_cte(entity: str, name: str | None = None) -> str:
    return f"{name or 'raw_' + entity} AS ({dt.duckdb_sql(entity)})"


def _zip(c: str) -> str:
    z = f"CAST(coalesce({c}, 0) AS VARCHAR)"
    return f"CASE WHEN length({z}) >= 5 THEN {z} ELSE lpad({z}, 5, '0') END"


def _city(c: str, min_len: int = 0) -> str:
    t = f"regexp_replace(lower(trim({c})), ' +', ' ', 'g')"
    short = f" OR length({t}) < {min_len}" if min_len else ""
    return f"CASE WHEN {t} IS NULL OR {t} = ''{short} THEN 'unknown' ELSE {t} END"


def _state(c: str) -> str:
    return f"CASE WHEN length(trim({c})) = 2 THEN upper(trim({c})) ELSE 'UN' END"


def _cat(c: str) -> str:
    return f"coalesce(nullif(lower(trim({c})), ''), 'unknown')"


def _nb(c: str) -> str:
    return f"nullif(trim({c}), '') IS NOT NULL"


def _dedup(src: str, keys: list[str], order: list[str], cols: list[str]) -> str:
    """Newest row per key; ties broken by every remaining column, all DESC NULLS LAST."""
    rest = [c for c in cols if c not in keys and c not in order]
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in order + rest)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {ob}) AS rn__ FROM {src}) WHERE rn__ = 1")


def _median(table: str, col: str) -> str:
    return f"(SELECT CAST(quantile_cont({col}, 0.5) AS DOUBLE) FROM {table})"


# ------------------------------------------------------------------ silver
SILVER_COLS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                  "customer_state", "created_at", "last_modified_at"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
                "geolocation_lat", "geolocation_lng"],
    "products": ["product_id", "product_category_name", "product_category_name_english",
                 "product_name_length", "product_description_length", "product_photos_qty",
                 "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
               "order_estimated_delivery_date", "created_at", "last_modified_at"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                    "price", "freight_value", "created_at", "last_modified_at"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments",
                       "payment_value", "created_at", "last_modified_at"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title",
                      "review_comment_message", "review_creation_date", "review_answer_timestamp",
                      "created_at", "last_modified_at"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
}


def silver_ctes(entity: str, raw: str | None = None, out: str | None = None,
                min_time: str = MIN, now: str = NOW) -> list[str]:
    """CTEs ending in ``out`` (default ``silver_<entity>``) that clean ``raw``
    (default: the fixture CTE ``raw_<entity>``, which is included)."""
    out = out or f"silver_{entity}"
    ctes = []
    if raw is None:
        raw = f"raw_{entity}"
        ctes.append(raw_cte(entity, raw))
    p = out + "_"
    cols = SILVER_COLS[entity]
    if entity == "customers":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(customer_id)) AS customer_id,
                 lower(trim(customer_unique_id)) AS customer_unique_id,
                 {_zip('customer_zip_code_prefix')} AS customer_zip_code_prefix,
                 {_city('customer_city', R.CITY_MIN_LENGTH)} AS customer_city,
                 {_state('customer_state')} AS customer_state,
                 created_at, last_modified_at
          FROM {raw}
          WHERE {_nb('customer_id')} AND {_nb('customer_unique_id')}
            AND length(lower(trim(customer_id))) = 32)""")
        ctes.append(f"{out} AS ({_dedup(p + 'c', ['customer_id'], ['last_modified_at'], cols)})")
    elif entity == "sellers":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(seller_id)) AS seller_id,
                 {_zip('seller_zip_code_prefix')} AS seller_zip_code_prefix,
                 {_city('seller_city')} AS seller_city, {_state('seller_state')} AS seller_state,
                 geolocation_lat, geolocation_lng
          FROM {raw} WHERE {_nb('seller_id')})""")
        ctes.append(f"{out} AS ({_dedup(p + 'c', ['seller_id'], [], cols)})")
    elif entity == "geolocation":
        ctes.append(f"""{p}c AS (
          SELECT {_zip('geolocation_zip_code_prefix')} AS geolocation_zip_code_prefix,
                 geolocation_lat, geolocation_lng FROM {raw})""")
        ctes.append(f"{out} AS ({_dedup(p + 'c', ['geolocation_zip_code_prefix'], [], cols)})")
    elif entity == "products":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(product_id)) AS product_id,
                 {_cat('product_category_name')} AS product_category_name,
                 {_cat('product_category_name_english')} AS product_category_name_english,
                 product_name_lenght AS product_name_length,
                 product_description_lenght AS product_description_length,
                 CASE WHEN product_photos_qty IS NULL OR product_photos_qty < 0 THEN 0.0
                      ELSE product_photos_qty END AS product_photos_qty,
                 CASE WHEN product_weight_g > 0 THEN product_weight_g END AS product_weight_g,
                 CASE WHEN product_length_cm > 0 THEN product_length_cm END AS product_length_cm,
                 CASE WHEN product_height_cm > 0 THEN product_height_cm END AS product_height_cm,
                 CASE WHEN product_width_cm > 0 THEN product_width_cm END AS product_width_cm
          FROM {raw} WHERE {_nb('product_id')})""")
        ctes.append(f"{p}d AS ({_dedup(p + 'c', ['product_id'], [], cols)})")
        d = p + "d"
        ctes.append(f"""{out} AS (
          SELECT product_id, product_category_name, product_category_name_english,
                 CAST(trunc(coalesce(product_name_length, {_median(d, 'product_name_length')})) AS INTEGER) AS product_name_length,
                 CAST(trunc(coalesce(product_description_length, {_median(d, 'product_description_length')})) AS INTEGER) AS product_description_length,
                 CAST(trunc(product_photos_qty) AS INTEGER) AS product_photos_qty,
                 coalesce(product_weight_g, {_median(d, 'product_weight_g')}) AS product_weight_g,
                 coalesce(product_length_cm, {_median(d, 'product_length_cm')}) AS product_length_cm,
                 coalesce(product_height_cm, {_median(d, 'product_height_cm')}) AS product_height_cm,
                 coalesce(product_width_cm, {_median(d, 'product_width_cm')}) AS product_width_cm
          FROM {d})""")
    elif entity == "orders":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(order_id)) AS order_id, lower(trim(customer_id)) AS customer_id,
                 {_cat('order_status')} AS order_status,
                 order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
                 order_delivered_customer_date, order_estimated_delivery_date,
                 created_at, last_modified_at
          FROM {raw}
          WHERE {_nb('order_id')} AND {_nb('customer_id')}
            AND order_purchase_timestamp >= TIMESTAMP '{min_time}'
            AND order_purchase_timestamp <= TIMESTAMP '{now}')""")
        ctes.append(f"{p}d AS ({_dedup(p + 'c', ['order_id'], ['last_modified_at', 'order_purchase_timestamp'], cols)})")
        ctes.append(f"""{out} AS (SELECT * FROM {p}d
          WHERE NOT (coalesce(order_delivered_customer_date < order_purchase_timestamp, false)
                  OR coalesce(order_delivered_carrier_date < order_purchase_timestamp, false)
                  OR coalesce(order_approved_at < order_purchase_timestamp, false)))""")
    elif entity == "order_items":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(order_id)) AS order_id, order_item_id,
                 lower(trim(product_id)) AS product_id, lower(trim(seller_id)) AS seller_id,
                 shipping_limit_date,
                 CASE WHEN price > 0 THEN price END AS price,
                 CASE WHEN freight_value IS NULL OR freight_value < 0 THEN 0.0 ELSE freight_value END AS freight_value,
                 created_at, last_modified_at
          FROM {raw}
          WHERE {_nb('order_id')} AND {_nb('product_id')} AND {_nb('seller_id')}
            AND order_item_id IS NOT NULL
            AND (shipping_limit_date IS NULL OR (shipping_limit_date >= TIMESTAMP '{min_time}'
                 AND shipping_limit_date <= TIMESTAMP '{now}')))""")
        ctes.append(f"{p}d AS ({_dedup(p + 'c', ['order_id', 'order_item_id'], ['last_modified_at', 'shipping_limit_date'], cols)})")
        d = p + "d"
        ctes.append(f"""{out} AS (
          SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
                 CAST(coalesce(price, {_median(d, 'price')}) AS DECIMAL(18,2)) AS price,
                 CAST(freight_value AS DECIMAL(18,2)) AS freight_value, created_at, last_modified_at
          FROM {d})""")
    elif entity == "order_payments":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(order_id)) AS order_id, payment_sequential,
                 coalesce(nullif(lower(trim(payment_type)), ''), 'Not Defined') AS payment_type,
                 CASE WHEN payment_installments IS NULL OR payment_installments < 1 THEN 1
                      ELSE payment_installments END AS payment_installments,
                 payment_value, created_at, last_modified_at
          FROM {raw}
          WHERE {_nb('order_id')} AND payment_sequential IS NOT NULL
            AND (payment_value IS NULL OR payment_value >= 0))""")
        ctes.append(f"{p}d AS ({_dedup(p + 'c', ['order_id', 'payment_sequential'], ['last_modified_at'], cols)})")
        d = p + "d"
        ctes.append(f"""{out} AS (
          SELECT order_id, payment_sequential, payment_type, payment_installments,
                 CAST(coalesce(payment_value, {_median(d, 'payment_value')}) AS DECIMAL(18,2)) AS payment_value,
                 created_at, last_modified_at
          FROM {d})""")
    elif entity == "order_reviews":
        ctes.append(f"""{p}c AS (
          SELECT lower(trim(review_id)) AS review_id, lower(trim(order_id)) AS order_id, review_score,
                 nullif(trim(review_comment_title), '') AS review_comment_title,
                 nullif(trim(review_comment_message), '') AS review_comment_message,
                 review_creation_date, review_answer_timestamp, created_at, last_modified_at
          FROM {raw}
          WHERE {_nb('review_id')} AND {_nb('order_id')}
            AND (review_score IS NULL OR review_score BETWEEN 1 AND 5)
            AND review_creation_date >= TIMESTAMP '{min_time}'
            AND review_creation_date <= TIMESTAMP '{now}')""")
        ctes.append(f"{p}d AS ({_dedup(p + 'c', ['review_id'], ['last_modified_at', 'review_creation_date'], cols)})")
        ctes.append(f"""{out} AS (SELECT * FROM {p}d
          WHERE NOT coalesce(review_answer_timestamp < review_creation_date, false))""")
    else:
        raise KeyError(entity)
    return ctes


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# ------------------------------------------------------------------ gold
def _geo_silver() -> list[str]:
    return ([raw_cte("geolocation", "geo_points"),
             """raw_geolocation AS (SELECT geolocation_zip_code_prefix,
                   avg(geolocation_lat) AS geolocation_lat, avg(geolocation_lng) AS geolocation_lng
                FROM geo_points GROUP BY geolocation_zip_code_prefix)"""]
            + silver_ctes("geolocation", raw="raw_geolocation"))


def _dd(d: str) -> str:
    return f"""CAST({d} AS DATE) AS date, CAST(year({d}) AS INTEGER) AS year,
      CAST(quarter({d}) AS INTEGER) AS quarter, 'Q' || CAST(quarter({d}) AS VARCHAR) AS quarter_name,
      CAST(month({d}) AS INTEGER) AS month, strftime({d}, '%B') AS month_name,
      strftime({d}, '%b') AS month_short, strftime({d}, '%b %Y') AS month_year,
      CAST(day({d}) AS INTEGER) AS day, strftime({d}, '%A') AS day_name, strftime({d}, '%a') AS day_short,
      dayofweek({d}) IN (0, 6) AS is_weekend,
      CAST(floor((dayofyear({d}) + dayofweek(date_trunc('year', {d})) - 1) / 7) + 1 AS INTEGER) AS week_of_year"""


def gold_ctes(silver_prefix: str = "silver_", g: str = "", with_views: bool = True) -> list[str]:
    """Dimensions, facts, calendar and views over ``<silver_prefix><entity>``;
    gold CTE names get the prefix ``g``."""
    s = silver_prefix
    out = [
        f"""{g}dim_customers AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id,
              customer_unique_id, customer_city, customer_state, customer_zip_code_prefix
            FROM {s}customers)""",
        f"""{g}dim_sellers AS (SELECT row_number() OVER (ORDER BY seller_id) AS seller_sk, seller_id,
              seller_city, seller_state, seller_zip_code_prefix,
              CAST(geolocation_lat AS DECIMAL(18,12)) AS seller_lat,
              CAST(geolocation_lng AS DECIMAL(18,12)) AS seller_lng
            FROM {s}sellers)""",
        f"""{g}dim_products AS (SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id,
              product_category_name, product_category_name_english, product_name_length,
              product_description_length, product_photos_qty,
              CAST(product_weight_g AS DECIMAL(10,2)) AS product_weight_g,
              CAST(product_length_cm AS DECIMAL(10,2)) AS product_length_cm,
              CAST(product_height_cm AS DECIMAL(10,2)) AS product_height_cm,
              CAST(product_width_cm AS DECIMAL(10,2)) AS product_width_cm
            FROM {s}products)""",
        f"""{g}fact_orders AS (SELECT row_number() OVER (ORDER BY o.order_id) AS order_sk, o.order_id,
              c.customer_sk, o.order_status,
              CAST(o.order_purchase_timestamp AS DATE) AS order_purchase_timestamp,
              CAST(o.order_approved_at AS DATE) AS order_approved_at,
              CAST(o.order_delivered_carrier_date AS DATE) AS order_delivered_carrier_date,
              CAST(o.order_delivered_customer_date AS DATE) AS order_delivered_customer_date,
              CAST(o.order_estimated_delivery_date AS DATE) AS order_estimated_delivery_date
            FROM {s}orders o JOIN {g}dim_customers c ON o.customer_id = c.customer_id)""",
        f"""{g}fact_order_items AS (SELECT row_number() OVER (ORDER BY i.order_id, i.order_item_id) AS order_item_sk,
              i.order_id, i.order_item_id, p.product_sk, x.seller_sk,
              CAST(i.shipping_limit_date AS DATE) AS shipping_limit_date, i.price, i.freight_value
            FROM {s}order_items i JOIN {g}dim_products p ON i.product_id = p.product_id
                 JOIN {g}dim_sellers x ON i.seller_id = x.seller_id)""",
        f"""{g}fact_order_payments AS (SELECT row_number() OVER (ORDER BY order_id, payment_sequential) AS order_payment_sk,
              order_id, payment_sequential, payment_type, payment_installments, payment_value
            FROM {s}order_payments WHERE order_id IN (SELECT order_id FROM {g}fact_orders))""",
        f"""{g}fact_order_reviews AS (SELECT row_number() OVER (ORDER BY review_id) AS order_review_sk,
              review_id, order_id, review_score, review_comment_title, review_comment_message,
              CAST(review_creation_date AS DATE) AS review_creation_date,
              CAST(review_answer_timestamp AS DATE) AS review_answer_date
            FROM {s}order_reviews WHERE order_id IN (SELECT order_id FROM {g}fact_orders))""",
    ]
    if not with_views:
        return out
    return out + [
        """cal_bounds AS (SELECT min(d) AS s, max(d) AS e FROM (
              SELECT order_purchase_timestamp AS d FROM fact_orders
              UNION ALL SELECT review_creation_date FROM fact_order_reviews))""",
        f"""dim_date AS (SELECT {_dd('d')} FROM (
              SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
              FROM cal_bounds))""",
        "v_dim_customers AS (SELECT * FROM dim_customers)",
        "v_dim_sellers AS (SELECT * FROM dim_sellers)",
        "v_dim_products AS (SELECT * FROM dim_products)",
        """v_fact_orders AS (SELECT order_sk, order_id, customer_sk, order_status,
              order_purchase_timestamp AS order_purchase_date, order_approved_at AS order_approved_date,
              order_delivered_carrier_date AS delivered_carrier_date,
              order_delivered_customer_date AS delivered_customer_date,
              order_estimated_delivery_date AS estimated_delivery_date FROM fact_orders)""",
        "v_fact_order_items AS (SELECT * FROM fact_order_items)",
        "v_fact_order_payments AS (SELECT * FROM fact_order_payments)",
        "v_fact_order_reviews AS (SELECT * FROM fact_order_reviews)",
    ]


def model_ctes() -> list[str]:
    """Every layer of the model from the fixtures."""
    ctes = []
    for e in ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"):
        ctes += silver_ctes(e)
    return ctes + _geo_silver() + gold_ctes()


def r4(x: str, d: int = 4) -> str:
    """Round like Spark's half-up on the shortest decimal form of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


# ------------------------------------------------------------------ merge / increments
GOLD_COLS = {
    "dim_customers": ("customer_sk", ["customer_id"], ["customer_id", "customer_unique_id", "customer_city",
                                                        "customer_state", "customer_zip_code_prefix"]),
    "fact_orders": ("order_sk", ["order_id"], ["order_id", "customer_sk", "order_status",
                    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date"]),
    "fact_order_items": ("order_item_sk", ["order_id", "order_item_id"], ["order_id", "order_item_id",
                         "product_sk", "seller_sk", "shipping_limit_date", "price", "freight_value"]),
    "fact_order_payments": ("order_payment_sk", ["order_id", "payment_sequential"], ["order_id",
                            "payment_sequential", "payment_type", "payment_installments", "payment_value"]),
    "fact_order_reviews": ("order_review_sk", ["review_id"], ["review_id", "order_id", "review_score",
                           "review_comment_title", "review_comment_message", "review_creation_date",
                           "review_answer_date"]),
}

GOLD_COLS["dim_sellers"] = ("seller_sk", ["seller_id"], ["seller_id", "seller_city", "seller_state",
                            "seller_zip_code_prefix", "seller_lat", "seller_lng"])
GOLD_COLS["dim_products"] = ("product_sk", ["product_id"], ["product_id", "product_category_name",
                             "product_category_name_english", "product_name_length", "product_description_length",
                             "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                             "product_width_cm"])

# The columns each MERGE updates (same lists as the library's).
MERGE_UPDATES = {
    "dim_customers": ["customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"],
    "fact_orders": ["order_status", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date"],
    "fact_order_items": ["product_sk", "seller_sk", "shipping_limit_date", "price", "freight_value"],
    "fact_order_payments": ["payment_type", "payment_installments", "payment_value"],
    "fact_order_reviews": ["review_score", "review_comment_title", "review_comment_message",
                           "review_creation_date", "review_answer_date"],
}


MERGE_UPDATES |= {t: GOLD_COLS[t][2][1:] for t in ("dim_sellers", "dim_products")}


def merge_cte(name: str, table: str, target: str, source: str) -> list[str]:
    """MERGE ``source`` into ``target`` as a full outer join (CTE ``name``)."""
    sk, keys, cols = GOLD_COLS[table]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    present = f"s.{keys[0]} IS NOT NULL"
    in_t = f"t.{keys[0]} IS NOT NULL"
    sel = [f"coalesce(t.{sk}, n.new_sk) AS {sk}"]
    for c in cols:
        if c in keys:
            sel.append(f"coalesce(t.{c}, s.{c}) AS {c}")
        elif c in MERGE_UPDATES[table]:
            sel.append(f"CASE WHEN {present} THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN {in_t} THEN t.{c} ELSE s.{c} END AS {c}")
    kl = ", ".join(keys)
    new = (f"SELECT {kl}, (SELECT coalesce(max({sk}), 0) FROM {target}) + row_number() OVER (ORDER BY {kl}) AS new_sk "
           f"FROM (SELECT {kl} FROM {source} EXCEPT SELECT {kl} FROM {target})")
    non = " AND ".join(f"n.{k} = s.{k}" for k in keys)
    return [f"{name}_new AS ({new})",
            f"{name} AS (SELECT {', '.join(sel)} FROM {target} t FULL OUTER JOIN {source} s ON {on} "
            f"LEFT JOIN {name}_new n ON {non})"]


INCR = ["customers", "orders", "order_items", "order_payments", "order_reviews"]
NEWEST = {"orders": ["last_modified_at", "order_purchase_timestamp"],
          "order_items": ["last_modified_at", "shipping_limit_date"],
          "order_payments": ["last_modified_at"],
          "order_reviews": ["last_modified_at", "review_creation_date"]}
SKEYS = {"orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
         "order_payments": ["order_id", "payment_sequential"], "order_reviews": ["review_id"]}
FACTS = {"orders": "fact_orders", "order_items": "fact_order_items",
         "order_payments": "fact_order_payments", "order_reviews": "fact_order_reviews"}


def _not_in(src: str, other: str, keys: list[str]) -> str:
    on = " AND ".join(f"x.{k} = y.{k}" for k in keys)
    return f"SELECT * FROM {src} x WHERE NOT EXISTS (SELECT 1 FROM {other} y WHERE {on})"


def _landing(e: str, src: str, g: str) -> str:
    if e == "orders":
        return (f"""SELECT o.order_id, c.customer_sk, o.order_status,
              CAST(o.order_purchase_timestamp AS DATE) AS order_purchase_timestamp,
              CAST(o.order_approved_at AS DATE) AS order_approved_at,
              CAST(o.order_delivered_carrier_date AS DATE) AS order_delivered_carrier_date,
              CAST(o.order_delivered_customer_date AS DATE) AS order_delivered_customer_date,
              CAST(o.order_estimated_delivery_date AS DATE) AS order_estimated_delivery_date
            FROM {src} o JOIN {g}dim_customers c ON o.customer_id = c.customer_id""")
    if e == "order_items":
        return (f"""SELECT i.order_id, i.order_item_id, p.product_sk, x.seller_sk,
              CAST(i.shipping_limit_date AS DATE) AS shipping_limit_date, i.price, i.freight_value
            FROM {src} i JOIN {g}dim_products p ON i.product_id = p.product_id
                 JOIN {g}dim_sellers x ON i.seller_id = x.seller_id""")
    if e == "order_payments":
        return (f"""SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
            FROM {src} WHERE order_id IN (SELECT order_id FROM {g}fact_orders)""")
    return (f"""SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
              CAST(review_creation_date AS DATE) AS review_creation_date,
              CAST(review_answer_timestamp AS DATE) AS review_answer_date
            FROM {src} WHERE order_id IN (SELECT order_id FROM {g}fact_orders)""")


def increment_ctes(cut: str = CUT) -> list[str]:
    """Initial load of the rows changed up to ``cut`` (prefix g1_, silver1_),
    then one batch with the rest (silver2_, g2_): merges, parking, landing."""
    ctes = []
    for e in ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"):
        ctes.append(raw_cte(e))
    for e in INCR:
        ctes.append(f"raw1_{e} AS (SELECT * FROM raw_{e} WHERE last_modified_at <= TIMESTAMP '{cut}' OR last_modified_at IS NULL)")
        ctes.append(f"raw2_{e} AS (SELECT * FROM raw_{e} WHERE last_modified_at > TIMESTAMP '{cut}')")
        ctes += silver_ctes(e, raw=f"raw1_{e}", out=f"silver1_{e}")
        ctes += silver_ctes(e, raw=f"raw2_{e}", out=f"silver2_{e}")
    for e in ("sellers", "products"):
        ctes += silver_ctes(e, raw=f"raw_{e}", out=f"silver1_{e}")
    ctes += gold_ctes("silver1_", "g1_", with_views=False)
    ctes.append("g2_dim_products AS (SELECT * FROM g1_dim_products)")
    ctes.append("g2_dim_sellers AS (SELECT * FROM g1_dim_sellers)")
    ctes.append("""src2_customers AS (SELECT customer_id, customer_unique_id, customer_city, customer_state,
                   customer_zip_code_prefix FROM silver2_customers)""")
    ctes += merge_cte("g2_dim_customers", "dim_customers", "g1_dim_customers", "src2_customers")
    for e, fact in FACTS.items():
        keys = SKEYS[e]
        ctes.append(f"parked1_{e} AS ({_not_in(f'silver1_{e}', f'g1_{fact}', keys)})")
        ctes.append(f"pend_union_{e} AS (SELECT * FROM parked1_{e} UNION ALL SELECT * FROM silver2_{e})")
        ctes.append(f"pend_{e} AS ({_dedup(f'pend_union_{e}', keys, NEWEST[e], SILVER_COLS[e])})")
        ctes.append(f"landed2_{e} AS ({_landing(e, f'pend_{e}', 'g2_')})")
        ctes += merge_cte(f"g2_{fact}", fact, f"g1_{fact}", f"landed2_{e}")
        ctes.append(f"parked2_{e} AS ({_not_in(f'pend_{e}', f'landed2_{e}', keys)})")
        # pure M1: batch rows landed against the initial gold only
        ctes.append(f"m_landed_{e} AS ({_landing(e, f'silver2_{e}', 'g1_')})")
        ctes += merge_cte(f"m_{fact}", fact, f"g1_{fact}", f"m_landed_{e}")
    ctes += merge_cte("m_dim_customers", "dim_customers", "g1_dim_customers", "src2_customers")
    return ctes


EARLIER = {
    "products": "SELECT * REPLACE ('old' AS product_category_name) FROM raw_products WHERE product_length_cm <= 25",
    "sellers": "SELECT * REPLACE ('old' AS seller_city) FROM raw_sellers WHERE geolocation_lat < 40",
}


def refresh_ctes(entity: str) -> list[str]:
    """The dimension of an earlier snapshot (prefix g1_), the whole one (prefix
    now_) and the refreshed one (prefix g2_), over all other entities whole."""
    dim, ctes = f"dim_{entity}", []
    for e in ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"):
        ctes += silver_ctes(e)
    ctes.append(f"raw1_{entity} AS ({EARLIER[entity]})")
    ctes += silver_ctes(entity, raw=f"raw1_{entity}", out=f"silver1_{entity}")
    for e in ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"):
        if e != entity:
            ctes.append(f"silver1_{e} AS (SELECT * FROM silver_{e})")
    ctes += gold_ctes("silver1_", "g1_", with_views=False) + gold_ctes("silver_", "now_", with_views=False)
    return ctes + merge_cte(f"g2_{dim}", dim, f"g1_{dim}", f"now_{dim}")


def watermark_sql(prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, max(created_at) AS max_created_at, "
        f"max(last_modified_at) AS max_last_modified_at, TIMESTAMP '{NOW}' AS last_load_timestamp "
        f"FROM {prefix}{e}" for e in INCR)
