"""Ids travel packed, parents are looked up once for landed and parked rows."""

import dataclasses
import hashlib
import re

from pyspark.sql import functions as F

from galaxia.functions.rules import pack_id, pack_key, unpack_id, unpack_key
from galaxia.operators.dedup import keep_latest
from galaxia.operators.ids import join_packed, mark_parents, packed, shown
from galaxia.operators.merge import upsert
from galaxia.plans import gold as G
from galaxia.plans import incremental as I
from galaxia.plans import silver as SV
from test_model import K, P, _sources, d, orders_df


def _md5(x):
    return hashlib.md5(str(x).encode()).hexdigest()


def test_packed_ids_keep_text_order_and_equality(spark):
    texts = ["", " ", "\0", "0", "/", ":", "9", "A", "Z", "`", "a", "f", "g", "\u00e9", "0" * 32, "f" * 32, "0" * 33, "f" * 31,
             "0" * 31 + "g", "9" * 31 + ":", "a" * 31 + "`", "e" * 31 + "/", "0f", "0ez", "A" * 32, "0" * 16, "0" * 17, "f" * 32 + " "]
    for i in range(60):
        h = _md5(i)
        texts += [h, h.upper(), h[:i % 33] + ":/g\u00e9 "[i % 5] + h[i % 33 + 1:], h[:i % 32]]
    rows = (spark.createDataFrame([(t,) for t in sorted(set(texts))] + [(None,)], "t string").repartition(3)
            .select("t", pack_id("t").alias("p"), unpack_id(pack_id("t")).alias("u"), pack_key("t").alias("k"),
                    unpack_key(pack_key("t")).alias("v")).collect())
    assert all(r.t == r.u == r.v for r in rows)
    held = [r for r in rows if r.t is not None]
    assert [r.t for r in sorted(held, key=lambda r: bytes(r.p))] == sorted(set(texts), key=lambda t: t.encode())
    assert len({bytes(r.k) for r in held}) == len(held)
    assert {len(r.p) for r in held if re.fullmatch("[0-9a-f]{32}", r.t)} == {17}


def _moved(df):
    """What the exchanges of a plan carry."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_shuffles_carry_packed_ids(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(_md5(1), 1, 5), (_md5(1), 2, 6), ("x", 3, 7), (None, 4, 8)], "order_id string, n int, v int")
        newest = keep_latest(df, ["order_id"], ["v"])
        joined = join_packed(df, df.select("order_id").distinct(), ["order_id"], "left_semi")
        assert sorted((r.n for r in newest.collect())) == [2, 3, 4]
        assert sorted((r.n for r in joined.collect())) == [1, 2, 3]
        for plan in (newest, joined):
            tree = plan._jdf.queryExecution().optimizedPlan().toString()
            assert "unhex(" in tree and _moved(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parent_held_twice_counts_once(spark):
    child = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "order_id string, n int")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "order_id string")
    assert sorted((r.n, r.has) for r in mark_parents(child, parent, ["order_id"], "has").collect()) == [(1, True), (2, None), (3, None)]


def test_looked_up_once_for_landed_and_parked(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1"), ("o1", 2, "p9", "s1"), ("o2", 1, "p1", "s9"), ("o3", 1, "p2", "s1")],
        "order_id string, order_item_id int, product_id string, seller_id string").withColumns(
        {"shipping_limit_date": F.lit("2000-01-01").cast("timestamp_ntz"), "price": F.lit(1).cast("decimal(18,2)"),
         "freight_value": F.lit(1).cast("decimal(18,2)"), "created_at": F.lit("2000-01-01").cast("timestamp_ntz"),
         "last_modified_at": F.lit("2000-01-02").cast("timestamp_ntz")})
    dims = {"dim_products": spark.createDataFrame([("p1", 1), ("p2", 2)], "product_id string, product_sk long"),
            "dim_sellers": spark.createDataFrame([("s1", 1)], "seller_id string, seller_sk long")}
    rows = G.looked_up("order_items", items, lambda table, src, key: dims[table])
    assert sorted((r.order_id, r.order_item_id, r.product_sk) for r in G.landed("order_items", rows).collect()) == [("o1", 1, 1), ("o3", 1, 2)]
    parked = G.parked("order_items", rows)
    assert parked.columns == items.columns
    assert sorted(map(tuple, parked.collect())) == sorted(map(tuple, items.where("product_id = 'p9' or seller_id = 's9'").collect()))


def _odd_rows(spark):
    return spark.createDataFrame([(_md5(1), 1), (_md5(2), 2), (_md5(3).upper(), 3), ("x", 4), ("", 5), (None, 6)], "order_id string, n int")


def test_operators_take_packed_ids_on_either_side(spark):
    text, part = _odd_rows(spark), _odd_rows(spark).where("n in (1, 3, 4, 5, 6)").withColumnRenamed("n", "m")
    for left, right in ((packed(text), part), (text, packed(part)), (packed(text), packed(part))):
        j = join_packed(left, right, ["order_id"], "left")
        assert j.schema["order_id"].dataType == left.schema["order_id"].dataType
        assert {(r.order_id, r.n, r.m) for r in shown(j).collect()} == {
            (_md5(1), 1, 1), (_md5(2), 2, None), (_md5(3).upper(), 3, 3), ("x", 4, 4), ("", 5, 5), (None, 6, None)}
        marked = mark_parents(left, right, ["order_id"], "has")
        assert {(r.order_id, r.n) for r in shown(marked).where("has").collect()} == {(_md5(1), 1), (_md5(3).upper(), 3), ("x", 4), ("", 5)}


def test_upsert_follows_the_ids_of_its_target(spark):
    target = spark.createDataFrame([(1, _md5(1), "a", "u"), (2, "x", "b", "v")], "order_sk long, order_id string, v string, customer_id string")
    source = spark.createDataFrame([(_md5(1), "c", "w"), (_md5(2), "d", _md5(9))], "order_id string, v string, customer_id string")
    want = {(1, _md5(1), "c", "w"), (2, "x", "b", "v"), (3, _md5(2), "d", _md5(9))}
    for t, s in ((target, source), (packed(target), source), (target, packed(source)), (packed(target), packed(source))):
        out = upsert(t, s, ["order_id"], ["v", "customer_id"], "order_sk")
        assert out.schema["order_id"].dataType == t.schema["order_id"].dataType
        assert {tuple(r) for r in shown(out).collect()} == want


def test_states_hold_ids_packed_and_show_them_as_text(spark):
    s1 = I.initial_load(_sources(spark, [(K[0], K[0], 1, "city", "SP", d(), d())], [(K[1], K[0], "a", d(), None, None, d())]), P, "2019-01-01 00:00:00")
    s2 = I.run_batch(s1, {"orders": orders_df(spark, [(K[2], K[0], "b", d(1), None, None, d(1)), (K[3], K[4], "c", d(1), None, None, d(1))])}, P, "2019-01-02 00:00:00")
    for table in ("fact_orders", "parked_orders"):
        assert dict(s2.packed[table].dtypes)["order_id"] == "binary"
        assert "hex(" not in s2.packed[table]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.order_id, r.order_sk) for r in s2["fact_orders"].collect()) == [(K[1], 1), (K[2], 2)]
    assert [(r.order_id, r.customer_id) for r in s2["parked_orders"].collect()] == [(K[3], K[4])]


def test_cleaning_rules_do_not_compute_their_columns_again(spark, scratch):
    orders_df(spark, [(K[1], K[0], "a", d(), None, None, d())]).write.parquet(scratch + "/orders")
    raw = spark.read.parquet(scratch + "/orders")
    for pack in (False, True):
        out = SV.clean_orders(raw, dataclasses.replace(P, packed=pack))
        tree = out._jdf.queryExecution().optimizedPlan().toString()
        assert [line for line in tree.splitlines() if "Filter" in line and "lower(trim(" in line] == []
        assert [r.order_id for r in shown(out).collect()] == [K[1]]
