"""Profiling aggregates (A2, A4, A7, A8) and medians.

Every profile is a single ``agg`` pass; results are reshaped into long form with
``stack`` on the JVM side.  Medians:

* :func:`approx_medians` -- ``percentile_approx`` with relative rank error
  ``rel_err`` (bounded sketch, one pass, all columns at once).
* :func:`exact_medians` -- ``percentile_cont(0.5)`` by refinement: sampled
  quantiles around the wanted rank cut the column to an open interval of a few
  ten-thousandths of its rows, exact counts place the rank in it, until a
  quantile holds the rank.  Every pass is one partial aggregation and returns one
  row per column; no task ever holds the values of a whole column (unlike an
  exact ``percentile`` aggregate, whose final merge keeps every distinct value in
  one task).  Only comparisons are used, so infinities and the full range of
  doubles are fine.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stack(df_one_row: DataFrame, items: list[tuple[str, list[str]]], names: list[str]) -> DataFrame:
    n = len(items)
    parts = []
    for label, cols in items:
        parts.append(f"'{label}'")
        parts.extend(f"`{c}`" for c in cols)
    expr = f"stack({n}, {', '.join(parts)}) as (column_name, {', '.join(names)})"
    return df_one_row.selectExpr(expr)


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: mean, sample stddev, min, max per column, in one pass."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    return _stack(one, [(c, [f"m{i}", f"s{i}", f"lo{i}", f"hi{i}"]) for i, c in enumerate(cols)],
                  ["mean", "stddev", "min", "max"])


def completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row count and non-null count per column (``.info()``)."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    st = _stack(one, [(c, ["n", f"c{i}"]) for i, c in enumerate(cols)], ["row_count", "non_null"])
    return st.withColumn("null_count", F.col("row_count") - F.col("non_null"))


def max_text_length(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The longest value of each text column."""
    one = df.agg(*[F.max(F.length(F.col(c))).alias(f"l{i}") for i, c in enumerate(cols)])
    return _stack(one, [(c, [f"l{i}"]) for i, c in enumerate(cols)], ["max_length"])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A2: frequency of each value, most frequent first."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(col).asc_nulls_last()))


def approx_medians(df: DataFrame, cols: Sequence[str], rel_err: float = 0.01) -> dict[str, float | None]:
    """A5: medians within ``rel_err`` rank error, one aggregate for all columns."""
    acc = max(1, int(round(1.0 / rel_err))) if rel_err > 0 else 1_000_000
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, acc).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: row[f"q{i}"] for i, c in enumerate(cols)}


def _stacked(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"))
                    for i, c in enumerate(cols)])
    return df.select(F.inline(arr)).where(F.col("v").isNotNull() & ~F.isnan("v"))


def _case(values: dict[int, float]) -> Column:
    expr = None
    for i, v in values.items():
        expr = (F.when(F.col("i") == i, F.lit(float(v))) if expr is None
                else expr.when(F.col("i") == i, F.lit(float(v))))
    return expr


def _step(st: DataFrame, state: dict[int, dict]) -> None:
    """One refinement of every column still open: three sampled quantiles around
    the wanted rank inside the open interval (one pass), then their exact ranks
    (another).  A quantile is a value of the column, so either it holds the rank
    or the interval loses it: each step leaves fewer distinct values."""
    inside = F.lit(False)
    for i, s in state.items():
        c = F.col("i") == i
        if s["lo"] is not None:
            c = c & (F.col("v") > F.lit(s["lo"]))
        if s["hi"] is not None:
            c = c & (F.col("v") < F.lit(s["hi"]))
        inside = inside | c
    cand, accuracy = st.where(inside), 10_000
    at = {}
    for i, s in state.items():
        p = (s["k"] - s["below"] + 0.5) / s["size"]
        at[i] = [min(max(p + d, 0.0), 1.0) for d in (-2.0 / accuracy, 0.0, 2.0 / accuracy)]
    row = cand.agg(*[F.percentile_approx(F.when(F.col("i") == i, F.col("v")), F.array(*map(F.lit, q)), F.lit(accuracy)).alias(f"q{i}")
                     for i, q in at.items()]).first()
    marks = {i: list(row[f"q{i}"]) for i in at}
    aggs = []
    for j in range(3):
        mark = _case({i: q[j] for i, q in marks.items()})
        aggs += [F.count(F.when(F.col("v") < mark, 1)).alias(f"lt{j}"), F.count(F.when(F.col("v") <= mark, 1)).alias(f"le{j}")]
    for r in cand.groupBy("i").agg(*aggs).collect():
        s, need = state[r["i"]], state[r["i"]]["k"] - state[r["i"]]["below"]
        top = s["size"]                       # values of the interval below its upper end
        for j in (2, 1, 0):
            if need < r[f"lt{j}"]:
                s["hi"], top = marks[r["i"]][j], r[f"lt{j}"]
        low = 0
        for j in (0, 1, 2):
            if r[f"lt{j}"] <= need < r[f"le{j}"]:
                s["found"] = marks[r["i"]][j]
            elif need >= r[f"le{j}"]:
                s["lo"], low = marks[r["i"]][j], r[f"le{j}"]
        s["below"], s["size"] = s["below"] + low, top - low


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact interpolated median (``percentile_cont(0.5)``) of each column,
    NULLs and NaNs ignored, infinities counted; only a column without a value
    gives ``None``."""
    st = _stacked(df, cols)
    state = {r["i"]: {"k": (r["n"] - 1) // 2, "n": r["n"], "size": r["n"], "below": 0, "lo": None, "hi": None, "found": None}
             for r in st.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    while (todo := {i: s for i, s in state.items() if s["found"] is None}):
        _step(st, todo)
    # second order statistic (rank k+1) for even counts, one pass for all columns
    even = {i: s for i, s in state.items() if s["n"] % 2 == 0}
    if even:
        x1 = _case({i: s["found"] for i, s in even.items()})
        rows = (st.where(F.col("i").isin(list(even)))
                  .groupBy("i").agg(F.count(F.when(F.col("v") <= x1, 1)).alias("le"),
                                    F.min(F.when(F.col("v") > x1, F.col("v"))).alias("nxt"))
                  .collect())
        for r in rows:
            s = even[r["i"]]
            s["second"] = s["found"] if r["le"] >= s["k"] + 2 else r["nxt"]
    return {c: midpoint(state[i]["found"], state[i].get("second", state[i]["found"])) if i in state else None
            for i, c in enumerate(cols)}


def midpoint(a: float, b: float) -> float:
    """Halfway from ``a`` to ``b``, also where their difference is no finite number."""
    if a == b:
        return a
    half = (b - a) * 0.5
    return a + half if math.isfinite(half) else a * 0.5 + b * 0.5


def medians(df: DataFrame, cols: Sequence[str], mode: str = "exact", rel_err: float = 0.01) -> dict:
    """Median of each column; ``mode`` is ``"exact"`` or ``"approx"``."""
    if not cols:
        return {}
    return exact_medians(df, cols) if mode == "exact" else approx_medians(df, cols, rel_err)
