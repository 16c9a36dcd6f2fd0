"""Registered queries against their DuckDB oracle (the driver's correctness gate).

By default a representative subset runs on sf0.001; set GALAXIA_ORACLE=all to
run every registered query (sf0.01 with GALAXIA_ORACLE_SF).
"""

import os

import pytest

from compare import compare, duck
from conftest import SF_SMALL

import __spark_entry__ as E

SF = os.environ.get("GALAXIA_ORACLE_SF", SF_SMALL)
SUBSET = ["clean_customers", "clean_order_items", "clean_payments", "dim_products", "fact_orders",
          "dim_date", "kpi_orders_by_state", "kpi_score_by_category", "merge_orders", "replay_two_batches",
          "changed_since", "stamp_changes", "check_fk", "reject_report", "exact_medians", "cohort_children",
          "exact_medians_nonfinite", "merge_payments", "merge_reviews", "refresh_products", "parked_items_landed", "late_batch",
          "table_roundtrip", "approx_medians", "silver_orders", "views_dim_products",
          "late_versions", "reversed_batches_orders", "reversed_batches_payments", "stream_refresh", "csv_quarantine"]
NAMES = sorted(E.oracle_sql()) if os.environ.get("GALAXIA_ORACLE") == "all" else SUBSET


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg


def test_every_query_has_an_oracle():
    from galaxia.catalog import QUERIES
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_state", "n_orders"]
    assert df.count() > 0
