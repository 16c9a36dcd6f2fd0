"""Table goldens, date dimension, increments (early facts, idempotence, crash)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from galaxia.functions.dates import build_dim_date
from galaxia.plans import incremental as I
from galaxia.plans import silver as SV
from galaxia.sources import schemas
from galaxia.sources.io import GoldStore

P = SV.Params(min_time="2016-01-01 00:00:00", now="2020-01-01 00:00:00")
K = [f"{i:032d}" for i in range(10)]
T0 = dt.datetime(2017, 1, 1)


def d(days=0, hours=0):
    return T0 + dt.timedelta(days=days, hours=hours)


def orders_df(spark, rows):
    """rows: (order_id, customer_id, status, purchase, approved, delivered, last_modified)"""
    full = [(o, c, s, p, a, None, dl, d(10) if p else None, None, None, p, lm) for o, c, s, p, a, dl, lm in rows]
    return spark.createDataFrame(full, schemas.RAW["orders"])


def test_clean_orders_golden(spark):
    rows = [
        (f" {K[1].upper()} ", K[0], " DELIVERED ", d(), d(hours=1), d(3), d()),   # kept, id and status cleaned
        (K[2], K[0], None, dt.datetime(2016, 1, 1), None, None, d()),         # lower bound kept, status unknown
        (K[3], K[0], "x", dt.datetime(2015, 12, 31), None, None, d()),        # before the window
        (K[4], K[0], "x", None, None, None, d()),                             # no purchase time
        (K[5], K[0], "x", dt.datetime(2021, 1, 1), None, None, d()),          # in the future
        (K[6], K[0], "old", d(), None, None, d()),                            # older version fine ...
        (K[6], K[0], "new", d(), d(-1), None, d(1)),                          # ... newest approved before purchase
        ("  ", K[0], "x", d(), None, None, d()),                               # blank id
        (K[7], "", "x", d(), None, None, d()),                                 # blank customer
    ]
    out = {r["order_id"]: r["order_status"] for r in SV.clean_orders(orders_df(spark, rows), P).collect()}
    assert out == {K[1]: "delivered", K[2]: "unknown"}


def test_clean_payments_median_and_filters(spark):
    rows = [(K[0], 1, "BOLETO", 0, 10.0), (K[0], 2, None, None, None), (K[0], 3, "", 3, 30.0),
            (K[0], 4, "x", 1, -1.0), (K[0], 5, "x", 2, 20.0)]
    df = spark.createDataFrame([r + (d(), d()) for r in rows], schemas.RAW["order_payments"])
    out = {r["payment_sequential"]: r for r in SV.clean_order_payments(df, P).collect()}
    assert set(out) == {1, 2, 3, 5}                       # negative value dropped
    assert float(out[2]["payment_value"]) == 20.0        # median of 10, 20, 30
    assert (out[1]["payment_type"], out[3]["payment_type"], out[2]["payment_type"]) == \
        ("boleto", "Not Defined", "Not Defined")
    assert (out[1]["payment_installments"], out[2]["payment_installments"]) == (1, 1)


def test_dim_date(spark):
    dd = build_dim_date(spark)
    assert dd.count() == 1096
    assert dd.where("is_weekend").count() == 314
    first = dd.where(F.col("date") == F.lit("2016-01-01").cast("date")).first().asDict()
    assert (first["quarter_name"], first["month_name"], first["month_short"], first["month_year"],
            first["day_name"], first["day_short"], first["is_weekend"], first["week_of_year"]) == \
        ("Q1", "January", "Jan", "Jan 2016", "Friday", "Fri", False, 1)
    sun = dd.where(F.col("date") == F.lit("2016-01-03").cast("date")).first()
    assert (sun["is_weekend"], sun["week_of_year"]) == (True, 2)
    assert dd.agg(F.max("week_of_year")).first()[0] == 53


def _sources(spark, customers, orders):
    empty = {e: schemas.empty(spark, schemas.RAW[e]) for e in
             ["sellers", "products", "order_items", "order_payments", "order_reviews"]}
    cust = spark.createDataFrame(customers, schemas.RAW["customers"])
    return {"customers": cust, "orders": orders_df(spark, orders), **empty}


def test_early_fact_parked_then_landed_once(spark):
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "a", d(), None, None, d()), (K[2], K[9], "b", d(), None, None, d())]  # K9 unknown yet
    s1 = I.initial_load(_sources(spark, c1, o1), P, "2019-01-01 00:00:00")
    assert [r["order_id"] for r in s1["fact_orders"].collect()] == [K[1]]
    assert [r["order_id"] for r in s1["parked_orders"].collect()] == [K[2]]
    batch = {"customers": spark.createDataFrame([(K[9], K[9], 1, "city", "RJ", d(2), d(2))],
                                                schemas.RAW["customers"]),
             "orders": orders_df(spark, [])}
    s2 = I.run_batch(s1, batch, P, "2019-01-02 00:00:00")
    got = sorted((r["order_id"], r["order_sk"]) for r in s2["fact_orders"].collect())
    assert got == [(K[1], 1), (K[2], 2)]
    assert s2["parked_orders"].count() == 0
    s3 = I.run_batch(s2, batch, P, "2019-01-03 00:00:00")        # same batch again: nothing changes
    assert sorted((r["order_id"], r["order_sk"]) for r in s3["fact_orders"].collect()) == got
    assert s3["dim_customers"].count() == 2


def test_merge_updates_listed_columns_only(spark):
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "shipped", d(), d(hours=1), None, d())]
    s1 = I.initial_load(_sources(spark, c1, o1), P, "2019-01-01 00:00:00")
    batch = {"orders": orders_df(spark, [(K[1], K[0], "delivered", d(1), None, d(4), d(5))])}
    row = I.run_batch(s1, batch, P, "2019-01-02 00:00:00")["fact_orders"].first()
    assert row["order_status"] == "delivered"
    assert row["order_approved_at"] is None                      # NULL overwrites
    assert row["order_purchase_timestamp"] == d().date()         # not in the update list
    assert row["order_sk"] == 1


def test_store_crash_before_publish_then_rerun(spark, scratch, monkeypatch):
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "shipped", d(), None, None, d())]
    store = GoldStore(spark, scratch + "/state", buckets=4)
    store.publish_initial(I.initial_load(_sources(spark, c1, o1), P, "2019-01-01 00:00:00"))
    before = store.manifest()
    batch = {"orders": orders_df(spark, [(K[2], K[0], "new", d(1), None, None, d(1))])}

    def boom(manifest):
        raise RuntimeError("crash before publish")
    monkeypatch.setattr(store, "_publish", boom)
    with pytest.raises(RuntimeError):
        store.run_batch(batch, P, "2019-01-02 00:00:00", batch_id=7)
    assert store.manifest() == before                              # old state untouched
    monkeypatch.undo()
    store.run_batch(batch, P, "2019-01-02 00:00:00", batch_id=7)
    store.run_batch(batch, P, "2019-01-02 00:00:00", batch_id=7)   # already applied: skipped
    got = sorted((r["order_id"], r["order_sk"]) for r in store.read("fact_orders").collect())
    assert got == [(K[1], 1), (K[2], 2)]


def test_store_batch_leaves_no_scratch(spark, scratch):
    import glob

    from galaxia.session import ensure_checkpoint_dir
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "shipped", d(), None, None, d())]
    store = GoldStore(spark, scratch + "/state", buckets=4)
    store.publish_initial(I.initial_load(_sources(spark, c1, o1), P, "2019-01-01 00:00:00"))
    base = ensure_checkpoint_dir(spark).replace("file:", "").rstrip("/") + "/galaxia-tables"
    before = set(glob.glob(base + "/batch-*"))
    store.run_batch({"orders": orders_df(spark, [(K[2], K[0], "new", d(1), None, None, d(1))])},
                    P, "2019-01-02 00:00:00", batch_id=1)
    assert set(glob.glob(base + "/batch-*")) == before
    assert store.read("fact_orders").count() == 2


def test_batch_without_values_uses_published_median(spark, scratch):
    from galaxia.sources import schemas as S
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "shipped", d(), None, None, d())]
    src = _sources(spark, c1, o1)
    src["order_payments"] = spark.createDataFrame(
        [(K[1], 1, "boleto", 1, 10.0, d(), d()), (K[1], 2, "boleto", 1, 30.0, d(), d())], S.RAW["order_payments"])
    params = SV.Params(min_time=P.min_time, now=P.now)
    state = I.initial_load(src, params, "2019-01-01 00:00:00")
    state["fact_order_payments"].count()
    assert params.observed == {"order_payments.payment_value": 20.0}
    store = GoldStore(spark, scratch + "/state", buckets=4)
    store.publish_initial(state, medians=params.observed)
    batch = {"order_payments": spark.createDataFrame([(K[1], 3, "boleto", 1, None, d(1), d(1))],
                                                     S.RAW["order_payments"])}
    store.run_batch(batch, P, "2019-01-02 00:00:00", batch_id=1)   # only a NULL value in this batch
    got = {r["payment_sequential"]: float(r["payment_value"]) for r in store.read("fact_order_payments").collect()}
    assert got == {1: 10.0, 2: 30.0, 3: 20.0}
    assert store.manifest()["medians"] == {"order_payments.payment_value": 20.0}


def test_run_initial_then_run_increment_from_watermarks(spark, scratch):
    c1 = [(K[0], K[0], 1, "city", "SP", d(), d())]
    o1 = [(K[1], K[0], "shipped", d(), None, None, d()), (K[2], K[0], "new", d(5), None, None, d(5))]
    src = _sources(spark, c1, o1)
    store = GoldStore(spark, scratch + "/state", buckets=4)
    # the first load sees only what had changed up to day 1
    I.run_initial(store, I.slice_changes(src, None, d(1)), P, "2019-01-01 00:00:00",
                  bronze_root=scratch + "/bronze")
    assert [r["order_id"] for r in store.read("fact_orders").collect()] == [K[1]]
    I.run_increment(store, src, P, "2019-01-02 00:00:00", batch_id=1, bronze_root=scratch + "/bronze")
    got = sorted((r["order_id"], r["order_sk"]) for r in store.read("fact_orders").collect())
    assert got == [(K[1], 1), (K[2], 2)]
    bronze = spark.read.parquet(scratch + "/bronze/orders")
    assert bronze.count() == 2 and "ingested_at" in bronze.columns   # K1 at first, then only K2 (changed since)


def test_kpis_carry_only_the_columns_they_read(spark):
    from galaxia.operators.ids import packed_view
    from galaxia.plans import kpis as KP
    from galaxia.plans import views as VW
    from galaxia.plans.gold import build_gold
    MEASURES = (1, 1, 1, 1.0, 1.0, 1.0, 1.0)
    silver = {
        "customers": [(K[0], K[0], "00001", "a", "SP", d(), d()), (K[1], K[0], "00001", "a", "RJ", d(), d())],
        "sellers": [(K[3], "00001", "a", "SP", 1.0, 2.0)],
        "products": [(K[4], "x", "x_en", *MEASURES), (K[5], "y", "y_en", *MEASURES)],
        "orders": [(K[i], K[i % 2], "delivered", d(40 * i), None, None, d(3), d(10), d(), d()) for i in (6, 7, 8)],
        "order_items": [(K[o], n, K[p], K[3], d(), D(price), D("1.00"), d(), d()) for o, n, p, price in
                        [(6, 1, 4, "10.00"), (6, 2, 5, "2.50"), (7, 1, 4, "4.00"), (7, 2, 9, "9.00")]],
        "order_payments": [(K[6], 1, "boleto", 1, D("5.00"), d(), d()), (K[8], 1, "boleto", 1, D("7.00"), d(), d())],
        "order_reviews": [(K[1], K[6], 5, None, None, d(), None, d(), d()), (K[2], K[7], 2, None, None, d(), None, d(), d())],
    }
    silver = {e: spark.createDataFrame(rows, schemas.SILVER[e]) for e, rows in silver.items()}

    def kpi(name, reads):
        gold = build_gold(silver, reads=reads)

        class Views(dict):
            def __missing__(self, v):
                return packed_view(VW.view(gold[v[2:]], v[2:]))
        return gold, [tuple(r) for r in KP.KPIS[name](Views()).collect()]
    for name in ("kpi_overview_totals", "kpi_score_by_category"):
        reads = KP.READS[name]
        gold, got = kpi(name, reads)
        assert got and sorted(got, key=repr) == sorted(kpi(name, None)[1], key=repr), name
        for t, columns in reads.items():
            sk, keys = schemas.GOLD_KEYS[t]
            assert set(gold[t].columns) == {sk, *keys, *columns}, (name, t)
