"""The reporting views -- snake-case names, ``*_timestamp`` shown as dates.

Views are column renames only; registered as temp views they are inlined by the
analyser, so pruning and filter pushdown still reach the stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RENAMES = {
    "fact_orders": {"order_purchase_timestamp": "order_purchase_date",
                    "order_approved_at": "order_approved_date",
                    "order_delivered_carrier_date": "delivered_carrier_date",
                    "order_delivered_customer_date": "delivered_customer_date",
                    "order_estimated_delivery_date": "estimated_delivery_date"},
}


def view(gold_table: DataFrame, table: str) -> DataFrame:
    """One reporting view over a gold table."""
    ren = RENAMES.get(table, {})
    return gold_table.select(*[F.col(c).alias(ren.get(c, c)) for c in gold_table.columns])


def views(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``v_<table>`` for every gold table."""
    return {f"v_{t}": view(df, t) for t, df in gold.items() if not t.startswith("parked_")}


def register_views(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Register the views as temp views (for Spark SQL users) and return them."""
    vs = views(gold)
    for name, df in vs.items():
        df.createOrReplaceTempView(name)
    return vs
