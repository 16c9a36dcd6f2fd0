"""Source entities derived from the driver's TPC-H-like tables.

The driver tables hold no NULL, blank, padding, late version or orphan, so the
raw entities of the order model are *derived* from them by deterministic SQL
that injects that dirt.  The same text runs in Spark (``spark.sql`` with the
parquet DataFrames bound to ``{table}`` placeholders) and in the DuckDB oracle
(plain view names), so the fixture is identical in both engines and the oracle
only has to re-implement the operators under test.  Every entity reads whole
driver tables; its size grows with theirs.

Mapping: customers <- customer x nation; sellers <- supplier x nation with zip
centroids from supplier; products <- part (+ a category lookup derived from
part, in which one type goes by another name and so finds no match); orders <-
orders; order items <- lineitem; payments <- events; reviews <- documents with
their labels where they have any.  Every change history runs over the cut-off, so
each batch of each entity holds new rows, updates and a NULL that overwrites.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .schemas import conform

# Fixed parameters of the driver fixture.
MIN_TIME = "1996-01-01 00:00:00"       # lower time bound of the fixture (orders start 1995)
NOW = "2002-01-01 00:00:00"            # the fixed "now" of the fixture
CUTOFF = "1999-01-01 00:00:00"         # initial load = changes up to here; the rest is increment 1

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "labels"]


SQL = {}

SQL["customers"] = """
WITH base AS (
  SELECT c.c_custkey AS k, n.n_name, n.n_nationkey, c.c_nationkey,
    CASE WHEN c.c_custkey % 29 = 0 THEN CAST(NULL AS STRING)
         WHEN c.c_custkey % 31 = 0 THEN substring(md5(CAST(c.c_custkey AS STRING)), 1, 31)
         WHEN c.c_custkey % 17 = 0 THEN concat('  ', upper(md5(CAST(c.c_custkey AS STRING))), ' ')
         ELSE md5(CAST(c.c_custkey AS STRING)) END AS customer_id,
    CASE WHEN c.c_custkey % 23 = 0 THEN '  '
         ELSE md5(concat('u', CAST(CAST(floor(c.c_custkey / 2) AS BIGINT) AS STRING))) END AS customer_unique_id,
    CASE WHEN c.c_custkey % 19 = 0 THEN CAST(NULL AS INT)
         WHEN c.c_custkey % 37 = 0 THEN CAST(100000 + c.c_nationkey * 1000 AS INT)
         ELSE CAST(c.c_nationkey * 100 + c.c_custkey % 7 AS INT) END AS customer_zip_code_prefix,
    CASE c.c_custkey % 10 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'ab'
         WHEN 3 THEN concat('  ', replace(n.n_name, '_', '   '), ' ')
         ELSE replace(n.n_name, '_', ' ') END AS customer_city,
    CASE c.c_custkey % 9 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'SPX' WHEN 2 THEN ''
         WHEN 3 THEN concat(' ', lower(substring(n.n_name, 1, 1)), CAST(n.n_nationkey % 10 AS STRING), ' ')
         ELSE concat(substring(n.n_name, 1, 1), CAST(n.n_nationkey % 10 AS STRING)) END AS customer_state,
    CASE WHEN c.c_custkey % 11 = 0 THEN CAST('1999-06-01 00:00:00' AS {TS})
         ELSE CAST('1995-01-01 00:00:00' AS {TS}) END
      + (c.c_custkey % 1000) * INTERVAL 1 MINUTE AS created_at
  FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
)
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       created_at, created_at AS last_modified_at
FROM base
UNION ALL
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
       concat(replace(n_name, '_', ' '), ' new'), customer_state,
       created_at, created_at + (k % 1500 + 300) * INTERVAL 1 DAY AS last_modified_at
FROM base WHERE k % 13 = 0
"""

SQL["geolocation"] = """
SELECT s_nationkey AS geolocation_zip_code_prefix,
       s_acctbal / 100.0 AS geolocation_lat,
       s_acctbal / -200.0 AS geolocation_lng
FROM {supplier}
"""

SQL["sellers"] = """
WITH base AS (
  SELECT s.s_suppkey AS k,
    CASE WHEN s.s_suppkey % 41 = 0 THEN CAST(NULL AS STRING)
         WHEN s.s_suppkey % 7 = 0 THEN concat(' ', upper(md5(concat('s', CAST(s.s_suppkey AS STRING)))), ' ')
         ELSE md5(concat('s', CAST(s.s_suppkey AS STRING))) END AS seller_id,
    CASE WHEN s.s_suppkey % 11 = 0 THEN CAST(NULL AS INT) ELSE s.s_nationkey END AS seller_zip_code_prefix,
    CASE s.s_suppkey % 6 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN ' '
         ELSE concat(' ', replace(n.n_name, '_', '  '), ' ') END AS seller_city,
    CASE WHEN s.s_suppkey % 5 = 0 THEN 'xyz'
         ELSE concat(lower(substring(n.n_name, 1, 1)), CAST(n.n_nationkey % 10 AS STRING)) END AS seller_state
  FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
), enriched AS (
  SELECT b.*, g.lat AS geolocation_lat, g.lng AS geolocation_lng
  FROM base b LEFT JOIN (
    SELECT s_nationkey AS zip, avg(s_acctbal / 100.0) AS lat, avg(s_acctbal / -200.0) AS lng
    FROM {supplier} GROUP BY s_nationkey) g
  ON b.seller_zip_code_prefix = g.zip
)
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, geolocation_lat, geolocation_lng
FROM enriched
UNION ALL
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, geolocation_lat, geolocation_lng
FROM enriched WHERE k % 8 = 0
"""

SQL["category_translation"] = """
SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN 'promotion' ELSE lower(p_type) END AS product_category_name,
       concat(lower(p_type), '_en') AS product_category_name_english
FROM {part}
"""

SQL["products"] = """
WITH base AS (
  SELECT p.p_partkey AS k,
    CASE WHEN p.p_partkey % 43 = 0 THEN CAST(NULL AS STRING)
         WHEN p.p_partkey % 9 = 0 THEN concat(' ', upper(md5(concat('p', CAST(p.p_partkey AS STRING)))), ' ')
         ELSE md5(concat('p', CAST(p.p_partkey AS STRING))) END AS product_id,
    CASE p.p_partkey % 8 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN ''
         ELSE concat(' ', p.p_type, ' ') END AS product_category_name,
    CASE WHEN p.p_partkey % 12 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(length(p.p_name) AS DOUBLE) END AS product_name_lenght,
    CASE WHEN p.p_partkey % 14 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(p.p_size * 10 AS DOUBLE) END AS product_description_lenght,
    CASE p.p_partkey % 10 WHEN 0 THEN CAST(NULL AS DOUBLE) WHEN 1 THEN CAST(-1 AS DOUBLE)
         ELSE CAST(p.p_size % 5 AS DOUBLE) END AS product_photos_qty,
    CASE p.p_partkey % 11 WHEN 0 THEN CAST(NULL AS DOUBLE) WHEN 1 THEN CAST(0 AS DOUBLE)
         WHEN 2 THEN CAST(-5 AS DOUBLE) ELSE p.p_retailprice END AS product_weight_g,
    CASE WHEN p.p_partkey % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(p.p_size AS DOUBLE) END AS product_length_cm,
    CASE WHEN p.p_partkey % 15 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p.p_size % 7 + 1 AS DOUBLE) END AS product_height_cm,
    CAST(p.p_partkey % 30 AS DOUBLE) AS product_width_cm,
    t.product_category_name_english
  FROM {part} p LEFT JOIN (
    SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN 'promotion' ELSE lower(p_type) END AS product_category_name,
           concat(lower(p_type), '_en') AS product_category_name_english
    FROM {part}) t
  ON lower(p.p_type) = t.product_category_name
)
SELECT product_id, product_category_name, product_name_lenght, product_description_lenght,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
       product_category_name_english
FROM base
UNION ALL
SELECT product_id, product_category_name, product_name_lenght, product_description_lenght,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
       product_category_name_english
FROM base WHERE k % 10 = 5
"""

SQL["orders"] = """
WITH base AS (
  SELECT o_orderkey AS k, o_orderdate AS od, o_orderstatus AS st,
    CASE WHEN o_orderkey % 53 = 0 THEN CAST(NULL AS STRING)
         WHEN o_orderkey % 10 = 3 THEN concat('  ', upper(md5(concat('o', CAST(o_orderkey AS STRING)))))
         ELSE md5(concat('o', CAST(o_orderkey AS STRING))) END AS order_id,
    CASE WHEN o_orderkey % 47 = 0 THEN '' ELSE md5(CAST(o_custkey AS STRING)) END AS customer_id,
    CASE WHEN o_orderkey % 61 = 0 THEN CAST(NULL AS {TS}) ELSE o_orderdate END AS order_purchase_timestamp
  FROM {orders}
)
SELECT order_id, customer_id,
  CASE WHEN k % 20 = 0 THEN CAST(NULL AS STRING) WHEN k % 20 = 1 THEN '  DELIVERED '
       WHEN st = 'F' THEN 'delivered' WHEN st = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
  order_purchase_timestamp,
  CASE WHEN k % 97 = 0 THEN od - INTERVAL 1 DAY ELSE od + (k % 3) * INTERVAL 1 HOUR END AS order_approved_at,
  CASE WHEN st = 'P' THEN CAST(NULL AS {TS}) ELSE od + (k % 4 + 1) * INTERVAL 1 DAY END AS order_delivered_carrier_date,
  CASE WHEN st <> 'F' THEN CAST(NULL AS {TS}) ELSE od + (k % 15 + 2) * INTERVAL 1 DAY END AS order_delivered_customer_date,
  od + INTERVAL 10 DAY AS order_estimated_delivery_date,
  CAST(year(od) AS INT) AS year, CAST(quarter(od) AS INT) AS quarter,
  od AS created_at, od + (k % 5) * INTERVAL 1 HOUR AS last_modified_at
FROM base
UNION ALL
SELECT order_id, customer_id,
  CASE WHEN k % 48 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status,
  order_purchase_timestamp,
  CASE WHEN k % 32 = 0 THEN od - INTERVAL 2 DAY WHEN k % 48 = 0 THEN CAST(NULL AS {TS})
       ELSE od + INTERVAL 2 HOUR END AS order_approved_at,
  od + INTERVAL 1 DAY AS order_delivered_carrier_date,
  CASE WHEN k % 48 = 0 THEN CAST(NULL AS {TS}) ELSE od + (k % 13 + 3) * INTERVAL 1 DAY END AS order_delivered_customer_date,
  od + INTERVAL 10 DAY AS order_estimated_delivery_date,
  CAST(year(od) AS INT) AS year, CAST(quarter(od) AS INT) AS quarter,
  od AS created_at, od + (k % 700 + 20) * INTERVAL 1 DAY AS last_modified_at
FROM base WHERE k % 16 = 0
"""

SQL["order_items"] = """
SELECT
  CASE WHEN l_orderkey % 10 = 3 THEN concat(' ', upper(md5(concat('o', CAST(l_orderkey AS STRING)))), '  ')
       ELSE md5(concat('o', CAST(l_orderkey AS STRING))) END AS order_id,
  l_linenumber AS order_item_id,
  CASE WHEN (l_orderkey + l_linenumber) % 83 = 0 THEN CAST(NULL AS STRING)
       ELSE md5(concat('p', CAST(l_partkey AS STRING))) END AS product_id,
  CASE WHEN (l_orderkey + l_linenumber) % 89 = 0 THEN ' '
       ELSE md5(concat('s', CAST(l_suppkey AS STRING))) END AS seller_id,
  CASE WHEN (l_orderkey + l_linenumber) % 71 = 0 THEN CAST(NULL AS {TS}) ELSE l_shipdate END AS shipping_limit_date,
  CASE WHEN l_partkey % 29 = 0 THEN CAST(NULL AS DOUBLE) WHEN l_partkey % 31 = 0 THEN CAST(0 AS DOUBLE)
       WHEN l_partkey % 37 = 0 THEN CAST(-1 AS DOUBLE) ELSE l_extendedprice END AS price,
  CASE WHEN l_suppkey % 19 = 0 THEN CAST(NULL AS DOUBLE) WHEN l_suppkey % 23 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE l_quantity / 4 END AS freight_value,
  l_shipdate AS created_at,
  l_shipdate + l_linenumber * INTERVAL 1 MINUTE AS last_modified_at
FROM {lineitem}
"""

SQL["order_payments"] = """
WITH base AS (
  SELECT event_id AS k, value,
    CAST('1996-01-01 00:00:00' AS {TS}) + (event_id % 40000) * INTERVAL 1 HOUR AS ts,
    CASE WHEN event_id % 43 = 0 THEN ' ' ELSE md5(concat('o', CAST(user_id AS STRING))) END AS order_id,
    CASE event_id % 6 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'BOLETO'
         WHEN 3 THEN ' credit_card ' WHEN 4 THEN 'voucher' ELSE 'debit_card' END AS payment_type,
    CASE event_id % 7 WHEN 0 THEN CAST(NULL AS INT) WHEN 1 THEN 0 WHEN 2 THEN -2
         ELSE CAST(event_id % 10 AS INT) END AS payment_installments
  FROM {events}
)
SELECT order_id, k AS payment_sequential, payment_type, payment_installments,
  CASE WHEN k % 13 = 0 THEN CAST(NULL AS DOUBLE) WHEN k % 17 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE value END AS payment_value,
  ts AS created_at, ts AS last_modified_at
FROM base
UNION ALL
SELECT order_id, k AS payment_sequential,
  CASE WHEN k % 18 = 0 THEN CAST(NULL AS STRING) ELSE payment_type END AS payment_type, payment_installments,
  value + 1 AS payment_value, ts AS created_at, ts + (k % 1400 + 1) * INTERVAL 1 DAY AS last_modified_at
FROM base WHERE k % 9 = 0
"""

SQL["order_reviews"] = """
WITH base AS (
  SELECT d.doc_id AS k, d.n_chars, l.quality, l.toxic, d.lang, d.text,
    CASE WHEN d.doc_id % 31 = 0 THEN ' '
         WHEN d.doc_id % 7 = 0 THEN concat(upper(md5(concat('r', CAST(d.doc_id AS STRING)))), ' ')
         ELSE md5(concat('r', CAST(d.doc_id AS STRING))) END AS review_id,
    md5(concat('o', CAST(d.doc_id AS STRING))) AS order_id,
    CASE WHEN d.doc_id % 29 = 0 THEN CAST(NULL AS {TS})
         WHEN d.doc_id % 37 = 0 THEN CAST('1995-06-01 00:00:00' AS {TS})
         ELSE CAST('1996-01-01 00:00:00' AS {TS}) + (d.doc_id * 37 % 17000) * INTERVAL 3 HOUR END AS cr
  FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
), dated AS (
  SELECT base.*,
    CASE WHEN k % 11 = 0 THEN CAST(NULL AS {TS}) WHEN k % 13 = 0 THEN cr - INTERVAL 1 DAY
         ELSE cr + (n_chars % 72) * INTERVAL 1 HOUR END AS ans
  FROM base
)
SELECT review_id, order_id,
  CASE WHEN k % 19 = 0 THEN CAST(NULL AS INT) ELSE CAST(1 + 4 * quality - toxic + k % 2 AS INT) END AS review_score,
  CASE WHEN k % 4 = 0 THEN '  ' ELSE concat(' ', lang, ' ') END AS review_comment_title,
  CASE WHEN k % 5 = 0 THEN ' ' ELSE text END AS review_comment_message,
  cr AS review_creation_date, ans AS review_answer_timestamp,
  cr AS created_at, coalesce(ans, cr) AS last_modified_at
FROM dated
UNION ALL
SELECT review_id, order_id, CAST(5 - toxic AS INT) AS review_score,
  CASE WHEN k % 18 = 0 THEN CAST(NULL AS STRING) ELSE concat(' ', lang, ' ') END AS review_comment_title, text AS review_comment_message,
  cr AS review_creation_date, cr + INTERVAL 2 DAY AS review_answer_timestamp,
  cr AS created_at, cr + (k % 1200 + 30) * INTERVAL 1 DAY AS last_modified_at
FROM dated WHERE k % 6 = 0
"""

_TABLE_RE = re.compile(r"\{(\w+)\}")


def duckdb_sql(entity: str) -> str:
    """The fixture for ``entity`` in DuckDB's dialect (tables are views)."""
    s = SQL[entity].replace("{TS}", "TIMESTAMP")
    s = s.replace("AS STRING)", "AS VARCHAR)")
    return _TABLE_RE.sub(lambda m: m.group(1), s)


def load_driver_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or DRIVER_TABLES
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw ``entity`` table built from the driver tables in ``sf_dir``,
    conformed to its source schema."""
    text = SQL[entity].replace("{TS}", "TIMESTAMP_NTZ")
    used = sorted(set(_TABLE_RE.findall(text)))
    tables = load_driver_tables(spark, sf_dir, used)
    df = spark.sql(text, **tables)
    return conform(df, schemas.RAW[entity])
