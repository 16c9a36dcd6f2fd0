"""K2-K17 kept up to date: sums by group that a batch adjusts by a difference.

Every KPI here is a sum over orders: what an order adds to it follows from the
order's own facts and the attributes of its customer and products.  A batch can
change only the orders that its landed rows belong to and those whose customer or
product it changed.  Their rows before and after the batch are two small images;
the stored sums lose what the first adds and gain what the second adds.  Gold is
not aggregated again: its order keys meet the touched ones in a semi join, whose
right side is as large as the batch and is broadcast where AQE finds it small.

K1 is not among them: its distinct customers are no sum.

Defined results: a NULL group is a group; a group whose last row is gone
disappears; KPIs without groups keep their one row, with zeros for counts and NULL
for ratios of nothing; a batch without rows changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ids import join_packed
from ..session import materialize
from ..sources import schemas
from . import views as VW
from .incremental import FACT_OF
from .kpis import _with_month
from .lazy import build_all, packed_tables

V = dict[str, DataFrame]
#: Rows behind a group; it decides whether the group is still there.
ROWS = "n_rows"
#: What a dimension gives to KPIs: its key, and the attribute that sums are grouped by.
ATTRIBUTES = {"dim_customers": ("customer_sk", "customer_state"),
              "dim_products": ("product_sk", "product_category_name_english")}


@dataclass(frozen=True)
class Additive:
    """``rows`` of the views, what one of them adds (SQL), and the KPI's columns (SQL
    over the sums, of the groups or, with ``whole``, over all groups together)."""
    rows: Callable[[V], DataFrame]
    groups: tuple[str, ...]
    adds: dict[str, str]
    shown: tuple[str, ...]
    whole: bool = False


def _ratio(num: str, den: str, name: str) -> str:
    return f"round(try_divide(cast({num} as double), cast({den} as double)), 4) as {name}"


_LATE = "delivered_customer_date > estimated_delivery_date"
_DAYS = "datediff(delivered_customer_date, order_purchase_date)"
_SCORES = {"score": "review_score", "scored": "int(review_score is not null)"}
_MEAN_SCORE = _ratio("score", "scored", "avg_score")


def _orders(v: V) -> DataFrame:
    return v["v_fact_orders"]


def _delivered(v: V) -> DataFrame:
    return _orders(v).where("delivered_customer_date is not null").withColumn("days", F.expr(_DAYS))


def _attribute(v: V, dim: str) -> DataFrame:
    return v[f"v_{dim}"].select(*ATTRIBUTES[dim])


def _payments(v: V) -> DataFrame:
    return v["v_fact_order_payments"]


def _reviews(v: V) -> DataFrame:
    return v["v_fact_order_reviews"]


def _dated(v: V, facts: DataFrame) -> DataFrame:
    return _with_month(facts.join(_orders(v).select("order_id", "order_purchase_date"), "order_id"), "order_purchase_date")


def _order_values(v: V) -> DataFrame:
    items = v["v_fact_order_items"].groupBy("order_id").agg(F.sum("price").cast("decimal(38,2)").alias("price"))
    return _dated(v, items)


def _reviews_by_state(v: V) -> DataFrame:
    return (_reviews(v).select("order_id", "review_score").join(_orders(v).select("order_id", "customer_sk"), "order_id")
            .join(_attribute(v, "dim_customers"), "customer_sk"))


def _reviews_by_category(v: V) -> DataFrame:
    held = (v["v_fact_order_items"].select("order_id", "product_sk").join(_attribute(v, "dim_products"), "product_sk")
            .select("order_id", "product_category_name_english").distinct())
    return _reviews(v).select("order_id", "review_score").join(held, "order_id")


_MONTH = ("year", "month")
_PAID = {"total": "payment_value", "paid": "int(payment_value is not null)"}

ADDITIVE = {
    "kpi_revenue_trend": Additive(_order_values, _MONTH, {"revenue": "price"}, ("revenue", f"{ROWS} as n_orders")),
    "kpi_orders_by_status": Additive(_orders, ("order_status",), {}, (f"{ROWS} as n_orders",)),
    "kpi_revenue_by_category": Additive(
        lambda v: v["v_fact_order_items"].join(_attribute(v, "dim_products"), "product_sk"),
        ("product_category_name_english",), {"revenue": "price"}, ("revenue", f"{ROWS} as n_items")),
    "kpi_order_totals": Additive(
        _orders, (), {"delivered_orders": "int(order_status = 'delivered')", "late_orders": f"int({_LATE})",
                      "days": _DAYS, "dated": f"int({_DAYS} is not null)"},
        (f"{ROWS} as total_orders", "delivered_orders", "late_orders", _ratio("days", "dated", "avg_delivery_days"))),
    "kpi_late_vs_on_time": Additive(
        lambda v: _delivered(v).withColumn("delivery_status", F.expr(f"if({_LATE}, 'late', 'on_time')")),
        ("delivery_status",), {}, (f"{ROWS} as n_orders",)),
    "kpi_orders_by_state": Additive(lambda v: _orders(v).join(_attribute(v, "dim_customers"), "customer_sk"),
                                    ("customer_state",), {}, (f"{ROWS} as n_orders",)),
    "kpi_delivery_performance": Additive(
        lambda v: _with_month(_delivered(v), "order_purchase_date"), _MONTH, {"late": f"int({_LATE})", "days": "days"},
        (f"{ROWS} as n_delivered", _ratio("late", ROWS, "late_rate"), _ratio("days", ROWS, "avg_delivery_days"))),
    "kpi_payment_totals": Additive(
        _payments, ("payment_type",), _PAID,
        ("sum(total) as total_payment", _ratio("sum(total)", "sum(paid)", "avg_payment"),
         f"coalesce(sum({ROWS}), 0L) as n_payments", "count(payment_type) as n_payment_types"), whole=True),
    "kpi_payment_trend": Additive(lambda v: _dated(v, _payments(v)), _MONTH, {"total_payment": "payment_value"},
                                  ("total_payment", f"{ROWS} as n_payments")),
    "kpi_payment_type_distribution": Additive(
        _payments, ("payment_type",), _PAID,
        (f"{ROWS} as n_payments", "total as total_value", _ratio(ROWS, f"(sum({ROWS}) over ())", "share"),
         _ratio("total", ROWS, "avg_value"))),
    "kpi_installments_analysis": Additive(_payments, ("payment_installments",), _PAID, (
        f"{ROWS} as n_payments", "total as total_value", _ratio("total", ROWS, "avg_value"))),
    "kpi_review_totals": Additive(
        _reviews, (), {**_SCORES, "n_five_star": "int(review_score = 5)", "answered": "int(review_answer_date is not null)"},
        (f"{ROWS} as n_reviews", _MEAN_SCORE, "n_five_star", _ratio("answered", ROWS, "response_rate"))),
    "kpi_score_trend": Additive(lambda v: _with_month(_reviews(v), "review_creation_date"), _MONTH, _SCORES,
                                (f"{ROWS} as n_reviews", _MEAN_SCORE)),
    "kpi_delivery_vs_review": Additive(
        lambda v: _reviews(v).join(_delivered(v).select("order_id", F.col("days").alias("delivery_days")), "order_id"),
        ("delivery_days",), _SCORES, (f"{ROWS} as n_reviews", _MEAN_SCORE)),
    "kpi_five_star_by_state": Additive(
        _reviews_by_state, ("customer_state",), {**_SCORES, "five": "int(review_score = 5)"},
        (f"{ROWS} as n_reviews", _ratio("five", "scored", "five_star_share"))),
    "kpi_score_by_category": Additive(_reviews_by_category, ("product_category_name_english",), _SCORES,
                                      (f"{ROWS} as n_reviews", _MEAN_SCORE)),
}
_MONEY = {"price", "payment_value"}


def _sum(name: str, sql: str):
    kind = "decimal(38,2)" if sql in _MONEY else "bigint"
    return F.coalesce(F.sum(F.expr(sql).cast(kind)), F.lit(0)).cast(kind).alias(name)


def sums(kpi: Additive, v: V) -> DataFrame:
    """The KPI's sums by group over the rows of the views."""
    return kpi.rows(v).groupBy(*kpi.groups).agg(_sum(ROWS, "1"), *[_sum(n, s) for n, s in kpi.adds.items()])


def moved(kpi: Additive, old: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The sums ``old`` without what ``before`` adds, with what ``after`` adds."""
    names = [ROWS, *kpi.adds]
    kinds = {f.name: f.dataType for f in old.schema}
    less = before.select(*kpi.groups, *[(-F.col(c)).cast(kinds[c]).alias(c) for c in names])
    all_ = old.unionByName(less).unionByName(after)
    out = all_.groupBy(*kpi.groups).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in names])
    return out.where(F.col(ROWS) != 0) if kpi.groups else out


def shown(kpi: Additive, state: DataFrame) -> DataFrame:
    """The KPI as ``plans.kpis`` gives it, from its sums."""
    return state.selectExpr(*kpi.shown) if kpi.whole else state.selectExpr(*kpi.groups, *kpi.shown)


def first(state: V, names=None, persist=materialize) -> V:
    """The sums of every KPI over a whole state (after an initial load)."""
    state = packed_tables(state)
    v = {f"v_{t}": VW.view(state[t], t) for t in (*FACT_OF.values(), *ATTRIBUTES)}
    return build_all(names or ADDITIVE, lambda n: persist(sums(ADDITIVE[n], v), n))


def touched_orders(prev: V, new: V) -> DataFrame:
    """order_id (packed) of every order that a batch may have changed.  ``new`` is the state
    that ``run_batch`` made of ``prev``; it knows the rows that landed."""
    prev, new = packed_tables(prev), packed_tables(new)
    parts = [new[f"landed_{e}"].select("order_id") for e in FACT_OF]
    # a review keeps the order it was first seen with, whatever a later version names
    reviews, keys = FACT_OF["order_reviews"], schemas.GOLD_KEYS[FACT_OF["order_reviews"]][1]
    parts.append(prev[reviews].join(new["landed_order_reviews"].select(*keys), keys, "left_semi").select("order_id"))
    for dim, fact in (("dim_customers", "fact_orders"), ("dim_products", "fact_order_items")):
        if (sent := new[f"rows_{dim}"]) is None:
            continue
        (sk, attribute), keys = ATTRIBUTES[dim], schemas.GOLD_KEYS[dim][1]
        sent = sent.select(*keys, F.col(attribute).alias("__new"))
        changed = (prev[dim].select(*keys, sk, attribute).join(sent, keys)
                   .where(~F.col(attribute).eqNullSafe(F.col("__new"))).select(sk))
        parts.append(prev[fact].join(changed, sk, "left_semi").select("order_id"))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def image(state: V, orders: DataFrame, persist=materialize) -> V:
    """The views with only the facts of ``orders``."""
    state = packed_tables(state)
    facts = build_all(FACT_OF.values(), lambda t: persist(join_packed(state[t], orders, ["order_id"], "left_semi"), f"image-{t}"))
    return {f"v_{t}": VW.view(df, t) for t, df in {**facts, **{t: state[t] for t in ATTRIBUTES}}.items()}


def advance(kpis: V, prev: V, new: V, persist=materialize) -> V:
    """The sums after the batch that turned the state ``prev`` into ``new``."""
    orders = persist(touched_orders(prev, new), "kpi-orders")
    before, after = image(prev, orders, persist), image(new, orders, persist)

    def adjusted(n: str) -> DataFrame:
        kpi = ADDITIVE[n]
        return persist(moved(kpi, kpis[n], sums(kpi, before), sums(kpi, after)), n)
    return build_all(kpis, adjusted)


def long_form(kpis: V) -> DataFrame:
    """kpi, grp, metric, value: all KPIs of the sums as one table."""
    parts = []
    for n, state in kpis.items():
        kpi = ADDITIVE[n]
        df = shown(kpi, state)
        groups = () if kpi.whole else kpi.groups
        label = F.concat_ws("/", *[F.coalesce(F.col(g).cast("string"), F.lit("")) for g in groups]) if groups else F.lit("")
        metrics = [c for c in df.columns if c not in groups]
        parts.append(df.select(label.alias("grp"), *[F.col(c).cast("double").alias(c) for c in metrics])
                       .unpivot("grp", metrics, "metric", "value").select(F.lit(n).alias("kpi"), "grp", "metric", "value"))
    return reduce(lambda a, b: a.unionByName(b), parts)
