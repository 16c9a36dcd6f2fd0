"""Benchmark: the headline work of the library on one driver folder.

Phases (each timed separately):
  initial_load  -- every source cleaned, gold built with surrogate keys, the
                   state published to a bucketed store (rows changed up to the
                   cut-off date);
  increment     -- the rest of the history as one batch: cleaned, merged into
                   the touched buckets only, parked rows retried, published;
  kpi_*         -- each dashboard KPI over the stored gold tables;
  audit_*       -- reject report and foreign-key audit over the sources.

Prints one JSON line.  Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    os.environ.setdefault("GALAXIA_MASTER", f"local[{cpus}]")

    from galaxia import catalog as C
    from galaxia.plans import incremental as I
    from galaxia.plans import kpis as K
    from galaxia.plans import views as VW
    from galaxia.session import build_session
    from galaxia.sources import driver_tables as dt
    from galaxia.sources.io import GoldStore

    spark = build_session(shuffle_partitions=max(8, cpus * 2), app="galaxia-bench")
    scratch = tempfile.mkdtemp(prefix="galaxia-bench-")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    model = C.Model(spark, sf_dir)
    ents = ["customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"]
    sources = {e: model.source(e) for e in ents}
    store = GoldStore(spark, f"{scratch}/state", buckets=max(8, cpus * 4),
                      workers=int(os.environ.get("BENCH_WORKERS", str(cpus))))

    def initial():
        import dataclasses
        params = dataclasses.replace(C.FIXTURE, observed={})
        state = I.initial_load(I.slice_changes(sources, None, dt.CUTOFF), params, dt.NOW)
        store.publish_initial(state, medians=params.observed)   # filled while the tables are built

    def increment():
        batch = {e: I.changed_since(sources[e], dt.CUTOFF) for e in I.INCREMENTAL}
        store.run_batch(batch, C.FIXTURE, dt.NOW, batch_id=1)

    timed("initial_load", initial)
    timed("increment", increment)

    m = store.manifest()
    gold = {t: store.read(t, manifest=m) for t in ["dim_customers", "dim_sellers", "dim_products",
                                                     "fact_orders", "fact_order_items",
                                                     "fact_order_payments", "fact_order_reviews"]}
    from galaxia.functions.dates import calendar_for
    gold["dim_date"] = calendar_for([(gold["fact_orders"], "order_purchase_timestamp"),
                                     (gold["fact_order_reviews"], "review_creation_date")]).cache()
    views = VW.views(gold)
    views["dim_date"] = gold["dim_date"]
    for name, fn in K.KPIS.items():
        timed(name, lambda fn=fn: fn(views).collect())
    timed("audit_reject_report", lambda: C.reject_report_query(spark, sf_dir).collect())
    timed("audit_check_fk", lambda: C.check_fk_query(spark, sf_dir).collect())

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus,
                      "rows_fact_order_items": gold["fact_order_items"].count()}))
    spark.stop()


if __name__ == "__main__":
    main()
