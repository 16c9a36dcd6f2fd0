"""Q1-Q6: audits the reference leaves to the eye or to database constraints.

Each audit is one aggregate pass whose result is small; nothing is collected
inside the library.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import completeness


def reject_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q1: for each named rule (a *keep* predicate) the number of rows it would
    drop, in one pass; ``total_rows`` beside it.  A NULL verdict counts as a
    drop, as in a ``WHERE``."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"__r{i}") for i, rule in enumerate(rules.values())]
    one = df.agg(*aggs)
    parts = ", ".join(f"'{name}', `__r{i}`" for i, name in enumerate(rules))
    return one.selectExpr(f"stack({len(rules)}, {parts}) as (rule, rejected_rows)", "__n as total_rows")


def date_error_report(df: DataFrame, flag: Column) -> DataFrame:
    """Q3: rows per value of a date-order flag."""
    return df.groupBy(flag.alias("date_logic_error")).agg(F.count(F.lit(1)).alias("n_rows"))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: keys held by more than one row (an empty result means the key is unique)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5: NULL count of each column that must not be NULL."""
    return completeness(df, cols).select("column_name", "null_count")


def check_fk(relations: dict[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """Q6: orphan count per relation ``name -> (child, parent, keys)``: child rows
    whose key is absent from the parent; a key with a NULL is in no parent.

    All relations are one audit: every table is read once, its rows give their keys
    marked with the parent's domain and the relation (-1: the parent's own), and one
    grouping, aggregated before its shuffle, finds the keys that no parent sent.  Key
    columns have the same type on both sides."""
    domains: dict[tuple, int] = {}
    tables: dict[int, DataFrame] = {}
    marks: dict[int, list[Column]] = {}
    for slot, (name, (child, parent, keys)) in enumerate(relations.items()):
        if [child.schema[k].dataType for k in keys] != [parent.schema[k].dataType for k in keys]:
            raise ValueError(f"{name}: the key's columns differ in type")
        whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
        cols = [F.col(f"`{k}`") for k in keys]
        key = F.when(whole, cols[0].cast("string") if len(cols) == 1 else F.to_json(F.struct(*cols)))
        first = (id(parent), *keys) not in domains
        domain = domains.setdefault((id(parent), *keys), len(domains))
        for df, mark in [(child, slot)] + [(parent, -1)] * first:
            tables[id(df)] = df
            marks.setdefault(id(df), []).append(F.struct(
                F.lit(domain).alias("domain"), key.alias("key"), F.lit(mark).alias("slot")))
    sent = [df.select(F.explode(F.array(*marks[i])).alias("m")).select("m.*") for i, df in tables.items()]
    counts = [F.count_if(F.col("slot") == i).alias(f"__r{i}") for i in range(len(relations))]
    found = F.max((F.col("slot") == -1) & F.col("key").isNotNull())
    by_key = reduce(lambda a, b: a.unionByName(b), sent).groupBy("domain", "key").agg(found.alias("__found"), *counts)
    one = by_key.where("NOT __found").agg(*[F.coalesce(F.sum(f"__r{i}"), F.lit(0)).alias(f"__r{i}") for i in range(len(relations))])
    parts = ", ".join(f"'{name}', `__r{i}`" for i, name in enumerate(relations))
    return one.selectExpr(f"stack({len(relations)}, {parts}) as (relation, orphans)")


def default_key_rows(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """per table, rows whose column carries its default value
    (``name -> (table, column, default)``), e.g. zip '00000' or city 'unknown'."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.lit(col).alias("column_name"),
                    F.count_if(F.col(col) == F.lit(default)).alias("default_rows"),
                    F.count(F.lit(1)).alias("total_rows"))
             for name, (df, col, default) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def parked_report(parked: dict[str, DataFrame], now_col) -> DataFrame:
    """I5 follow-up: parked rows are never dropped; per table report how many
    wait, and the oldest and newest change time among them (their age)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("parked_rows"),
                    F.min("last_modified_at").alias("oldest_change"),
                    F.max("last_modified_at").alias("newest_change"),
                    F.max(F.datediff(now_col, F.col("last_modified_at"))).alias("max_age_days"))
             for name, df in parked.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
