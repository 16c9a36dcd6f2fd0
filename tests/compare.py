"""Order-insensitive comparison of a Spark result with a DuckDB oracle query."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def rows(records) -> list[tuple]:
    out = [tuple(_norm(v) for v in r) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                  "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def type_diffs(spark_df, con, sql: str) -> list:
    """Columns whose Spark type and DuckDB type differ."""
    res = con.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {r[0]: r[1] for r in res}
    out = []
    for f in spark_df.schema.fields:
        st = f.dataType.simpleString()
        want = _SPARK_TO_DUCK.get(st, st.upper())
        if duck_types.get(f.name) != want:
            out.append((f.name, st, duck_types.get(f.name)))
    return out


def compare(spark_df, con, sql: str):
    """Return (ok, detail)."""
    cols = spark_df.columns
    s_rows = rows([tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_raw = res.fetchall()
    if sorted(cols) != sorted(d_cols):
        return False, f"columns differ: spark={cols} duck={d_cols}"
    idx = [d_cols.index(c) for c in cols]
    d_rows = rows([tuple(r[i] for i in idx) for r in d_raw])
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    if s_rows != d_rows:
        bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return False, f"values differ, e.g. {bad}"
    return True, f"{len(s_rows)} rows"
