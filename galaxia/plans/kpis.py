"""Dashboard KPIs over the reporting views.

The reference names these KPIs but does not ship their formulas; the
definitions here are ours (documented per function).  Each is a
``join`` + ``groupBy().agg()`` plan: partial aggregation runs before the
shuffle, dimension lookups are equi-joins that AQE may turn into broadcasts,
and nothing is collected.  Ratios are rounded to 4 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

V = dict[str, DataFrame]


def _r(c, d: int = 4):
    return F.round(c, d)


def _money(c: str):
    """A sum of money columns, at the widest decimal precision."""
    return F.sum(c).cast("decimal(38,2)")


def _ratio(num, den, d: int = 4):
    """Rounded; NULL where ``den`` is 0 (a group without a value)."""
    return _r(F.try_divide(num.cast("double"), den.cast("double")), d)


def _with_month(df: DataFrame, date_col: str) -> DataFrame:
    """Year and month of ``date_col``, as the date dimension has them; rows without
    a date are in no month."""
    return (df.where(F.col(date_col).isNotNull())
              .withColumns({"year": F.year(date_col), "month": F.month(date_col)}))


def overview_totals(v: V) -> DataFrame:
    """K1: revenue = sum of item prices; orders = rows of fact_orders; customers =
    distinct customer_unique_id; average order value = revenue / distinct orders
    with items."""
    items = v["v_fact_order_items"].agg(_money("price").alias("total_revenue"),
                                        F.countDistinct("order_id").alias("orders_with_items"))
    orders = v["v_fact_orders"].agg(F.count(F.lit(1)).alias("total_orders"))
    cust = v["v_dim_customers"].agg(F.countDistinct("customer_unique_id").alias("total_customers"))
    one = items.crossJoin(orders).crossJoin(cust)   # three 1-row aggregates
    return one.select("total_revenue", "total_orders", "total_customers",
                      _ratio(F.col("total_revenue"), F.col("orders_with_items"), 2).alias("avg_order_value"))


def revenue_trend(v: V) -> DataFrame:
    """K2: item revenue and order count per purchase year and month."""
    per_order = v["v_fact_order_items"].groupBy("order_id").agg(_money("price").alias("price"))
    j = per_order.join(v["v_fact_orders"].select("order_id", "order_purchase_date"), "order_id")
    return _with_month(j, "order_purchase_date").groupBy("year", "month").agg(
        _money("price").alias("revenue"), F.count(F.lit(1)).alias("n_orders"))


def orders_by_status(v: V) -> DataFrame:
    """K3: orders per status."""
    return v["v_fact_orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders"))


def revenue_by_category(v: V) -> DataFrame:
    """K4: item revenue and item count per English category name."""
    j = v["v_fact_order_items"].join(
        v["v_dim_products"].select("product_sk", "product_category_name_english"), "product_sk")
    return j.groupBy("product_category_name_english").agg(_money("price").alias("revenue"),
                                                          F.count(F.lit(1)).alias("n_items"))


def _late(o: DataFrame):
    return F.col("delivered_customer_date") > F.col("estimated_delivery_date")


def _days(o: DataFrame):
    return F.datediff("delivered_customer_date", "order_purchase_date")


def order_totals(v: V) -> DataFrame:
    """K5: total orders, delivered orders (status 'delivered'), late orders
    (delivered after the estimate), mean days from purchase to delivery."""
    o = v["v_fact_orders"]
    return o.agg(F.count(F.lit(1)).alias("total_orders"),
                 F.count_if(F.col("order_status") == "delivered").alias("delivered_orders"),
                 F.count_if(_late(o)).alias("late_orders"),
                 _r(F.avg(_days(o))).alias("avg_delivery_days"))


def late_vs_on_time(v: V) -> DataFrame:
    """K6: orders with a delivery date, split into late and on time."""
    o = v["v_fact_orders"].where(F.col("delivered_customer_date").isNotNull())
    return (o.groupBy(F.when(_late(o), "late").otherwise("on_time").alias("delivery_status"))
             .agg(F.count(F.lit(1)).alias("n_orders")))


def orders_by_state(v: V) -> DataFrame:
    """K7: orders per customer state."""
    j = v["v_fact_orders"].join(v["v_dim_customers"].select("customer_sk", "customer_state"), "customer_sk")
    return j.groupBy("customer_state").agg(F.count(F.lit(1)).alias("n_orders"))


def delivery_performance(v: V) -> DataFrame:
    """K8: per purchase year and month: late share and mean delivery days of
    orders with a delivery date."""
    o = v["v_fact_orders"].where(F.col("delivered_customer_date").isNotNull())
    o = _with_month(o, "order_purchase_date")
    return o.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_delivered"),
        _ratio(F.count_if(_late(o)), F.count(F.lit(1))).alias("late_rate"),
        _r(F.avg(_days(o))).alias("avg_delivery_days"))


def payment_totals(v: V) -> DataFrame:
    """K9: sum, mean, count of payments and number of payment types."""
    p = v["v_fact_order_payments"]
    return p.agg(_money("payment_value").alias("total_payment"),
                 _ratio(F.sum("payment_value"), F.count("payment_value")).alias("avg_payment"),
                 F.count(F.lit(1)).alias("n_payments"),
                 F.countDistinct("payment_type").alias("n_payment_types"))


def payment_trend(v: V) -> DataFrame:
    """Payment value and count per purchase year and month of the order."""
    j = v["v_fact_order_payments"].join(v["v_fact_orders"].select("order_id", "order_purchase_date"),
                                        "order_id")
    j = _with_month(j, "order_purchase_date")
    return j.groupBy("year", "month").agg(_money("payment_value").alias("total_payment"),
                                          F.count(F.lit(1)).alias("n_payments"))


def payment_type_distribution(v: V) -> DataFrame:
    """Per payment type: count, share of all payments, total and mean value."""
    p = v["v_fact_order_payments"]
    by = p.groupBy("payment_type").agg(F.count(F.lit(1)).alias("n_payments"),
                                       _money("payment_value").alias("total_value"))
    total = p.agg(F.count(F.lit(1)).alias("__all"))          # one row: safe to broadcast
    return (by.crossJoin(F.broadcast(total))
              .select("payment_type", "n_payments", "total_value",
                      _ratio(F.col("n_payments"), F.col("__all")).alias("share"),
                      _ratio(F.col("total_value"), F.col("n_payments")).alias("avg_value")))


def installments_analysis(v: V) -> DataFrame:
    """Per number of installments: count, total and mean value."""
    return (v["v_fact_order_payments"].groupBy("payment_installments")
            .agg(F.count(F.lit(1)).alias("n_payments"), _money("payment_value").alias("total_value"))
            .withColumn("avg_value", _ratio(F.col("total_value"), F.col("n_payments"))))


def review_totals(v: V) -> DataFrame:
    """Reviews, mean score, five-star count, share with an answer date."""
    r = v["v_fact_order_reviews"]
    return r.agg(F.count(F.lit(1)).alias("n_reviews"),
                 _ratio(F.sum("review_score"), F.count("review_score")).alias("avg_score"),
                 F.count_if(F.col("review_score") == 5).alias("n_five_star"),
                 _ratio(F.count("review_answer_date"), F.count(F.lit(1))).alias("response_rate"))


def score_trend(v: V) -> DataFrame:
    """Mean score per review creation year and month."""
    r = _with_month(v["v_fact_order_reviews"], "review_creation_date")
    return r.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        _ratio(F.sum("review_score"), F.count("review_score")).alias("avg_score"))


def delivery_vs_review(v: V) -> DataFrame:
    """Mean score per number of days from purchase to delivery."""
    o = v["v_fact_orders"].where(F.col("delivered_customer_date").isNotNull()).select(
        "order_id", _days(v["v_fact_orders"]).alias("delivery_days"))
    j = v["v_fact_order_reviews"].join(o, "order_id")
    return j.groupBy("delivery_days").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        _ratio(F.sum("review_score"), F.count("review_score")).alias("avg_score"))


def five_star_by_state(v: V) -> DataFrame:
    """Share of five-star reviews per customer state."""
    j = (v["v_fact_order_reviews"].select("order_id", "review_score")
         .join(v["v_fact_orders"].select("order_id", "customer_sk"), "order_id")
         .join(v["v_dim_customers"].select("customer_sk", "customer_state"), "customer_sk"))
    return j.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        _ratio(F.count_if(F.col("review_score") == 5), F.count("review_score")).alias("five_star_share"))


def score_by_category(v: V) -> DataFrame:
    """Mean score per English category; an order's review counts once per
    category it contains (distinct order/category pairs stop multi-item fan-out)."""
    reviewed = v["v_fact_order_reviews"].select("order_id")
    cats = (v["v_fact_order_items"].select("order_id", "product_sk").join(reviewed, "order_id", "left_semi")
            .join(v["v_dim_products"].select("product_sk", "product_category_name_english"), "product_sk")
            .select("order_id", "product_category_name_english").distinct())
    j = v["v_fact_order_reviews"].select("order_id", "review_score").join(cats, "order_id")
    return j.groupBy("product_category_name_english").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        _ratio(F.sum("review_score"), F.count("review_score")).alias("avg_score"))


KPIS = {
    "kpi_overview_totals": overview_totals,
    "kpi_revenue_trend": revenue_trend,
    "kpi_orders_by_status": orders_by_status,
    "kpi_revenue_by_category": revenue_by_category,
    "kpi_order_totals": order_totals,
    "kpi_late_vs_on_time": late_vs_on_time,
    "kpi_orders_by_state": orders_by_state,
    "kpi_delivery_performance": delivery_performance,
    "kpi_payment_totals": payment_totals,
    "kpi_payment_trend": payment_trend,
    "kpi_payment_type_distribution": payment_type_distribution,
    "kpi_installments_analysis": installments_analysis,
    "kpi_review_totals": review_totals,
    "kpi_score_trend": score_trend,
    "kpi_delivery_vs_review": delivery_vs_review,
    "kpi_five_star_by_state": five_star_by_state,
    "kpi_score_by_category": score_by_category,
}

#: What each KPI reads of the tables that move most, besides their keys: other columns
#: need not be carried through lookups and surrogate keys.
READS = {
    "kpi_overview_totals": {"fact_order_items": ["price"], "fact_orders": [], "dim_customers": ["customer_unique_id"]},
    "kpi_revenue_trend": {"fact_order_items": ["price"], "fact_orders": ["order_purchase_timestamp"]},
    "kpi_revenue_by_category": {"fact_order_items": ["product_sk", "price"], "dim_products": ["product_category_name_english"]},
    "kpi_payment_trend": {"fact_order_payments": ["payment_value"], "fact_orders": ["order_purchase_timestamp"]},
    "kpi_five_star_by_state": {"fact_order_reviews": ["order_id", "review_score"], "fact_orders": ["customer_sk"],
                               "dim_customers": ["customer_state"]},
    "kpi_score_by_category": {"fact_order_items": ["product_sk"], "fact_order_reviews": ["order_id", "review_score"],
                              "fact_orders": [], "dim_products": ["product_category_name_english"]},
}
