"""Additive KPIs adjusted by a batch's images against their full computation."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from galaxia import catalog as C
from galaxia.plans import kpi_state as KS
from galaxia.plans import kpis as K
from galaxia.plans import views as VW
from galaxia.sources import driver_tables as D


@pytest.fixture(scope="module")
def history(spark):
    """States after the first load, a batch of new and changed rows, and a batch that
    moves customers to another state, products to another category and reviews to
    another score (and names another order, which a known review does not follow)."""
    inc = C.Increment(spark, SF_SMALL)
    later = F.lit("2199-01-01 00:00:00").cast("timestamp_ntz")
    other = F.lit(inc.s1["fact_orders"].agg(F.min("order_id")).first()[0])
    some = F.crc32(F.col("customer_id").cast("binary")) % 5 == 0
    third = {"customers": inc.sources["customers"].withColumns(
                 {"customer_state": F.when(some, "ZZ").otherwise(F.col("customer_state")), "last_modified_at": later}),
             "products": inc.sources["products"].withColumn("product_category_name_english", F.when(
                 F.crc32(F.col("product_id").cast("binary")) % 4 == 0, "moved").otherwise(F.col("product_category_name_english"))),
             "order_reviews": inc.sources["order_reviews"].withColumns(
                 {"review_score": 6 - F.col("review_score"), "last_modified_at": later,
                  "order_id": F.when(F.crc32(F.col("review_id").cast("binary")) % 3 == 0, other).otherwise(F.col("order_id"))})}
    states = [inc.s1, inc.s2, inc.I.run_batch(inc.s2, third, C.FIXTURE, D.NOW)]
    kpis = [KS.first(states[0])]
    for before, after in zip(states, states[1:]):
        kpis.append(KS.advance(kpis[-1], before, after))
    return inc, states, kpis


def _rows(df):
    def plain(v):
        return float(v) if isinstance(v, Decimal) else v
    return sorted((sorted((k, plain(v)) for k, v in r.asDict().items()) for r in df.collect()), key=str)


@pytest.mark.parametrize("after", [1, 2])
def test_adjusted_kpis_equal_full_ones(history, after):
    _, states, kpis = history
    views = {f"v_{t}": VW.view(states[after][t], t) for t in (*KS.FACT_OF.values(), *KS.ATTRIBUTES)}
    for n, kpi in KS.ADDITIVE.items():
        assert _rows(KS.shown(kpi, kpis[after][n])) == _rows(K.KPIS[n](views)), n


def test_the_batches_move_every_kpi_source(history):
    _, _, kpis = history
    for n in ("kpi_orders_by_state", "kpi_revenue_by_category", "kpi_score_trend"):
        assert _rows(kpis[1][n]) != _rows(kpis[2][n]), n


def test_an_empty_batch_touches_nothing(history):
    inc, states, _ = history
    nothing = {e: df.where("false") for e, df in inc.batch2.items()}
    assert KS.touched_orders(states[1], inc.I.run_batch(states[1], nothing, C.FIXTURE, D.NOW)).count() == 0


def test_every_kpi_but_the_distinct_one_is_kept():
    assert set(K.KPIS) - set(KS.ADDITIVE) == {"kpi_overview_totals"}


def test_groups_that_empty_disappear_and_null_groups_count(spark):
    kpi = KS.ADDITIVE["kpi_orders_by_status"]
    old, before, after = (spark.createDataFrame(r, "order_status string, n_rows long") for r in (
        [("a", 2), (None, 1)], [("a", 2), (None, 1)], [("b", 1), (None, 3)]))
    assert {tuple(r) for r in KS.moved(kpi, old, before, after).collect()} == {("b", 1), (None, 3)}
