"""Connected components of an edge table, by large-star / small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond").  Every round
is two joins of the edges with a minimum per node; nothing is collected, and a
round's result is a table in the shared folder, so a lost executor costs at most
one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _with_least(edges: DataFrame, node: str, other: str, name: str) -> DataFrame:
    """Edges with ``m``, the least of a node and its neighbours."""
    least = edges.groupBy(node).agg(F.least(F.min(other), F.col(node)).alias("m"))
    least = materialize(least.withColumnRenamed(node, "n"), name)   # a plain table: AQE can split a hot node's join
    return edges.join(least, F.col(node) == F.col("n"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (_with_least(both, "a", "b", "large-star").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = _with_least(down, "a", "b", "small-star")
    rows = found.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                          F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
    return rows.select("e.*").where("a <> b").distinct()


def _state(edges: DataFrame):
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """From undirected edges (a, b): node, root, for every node that has an edge to
    another; root is the component's least node."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = materialize(_small_star(materialize(_large_star(edges), "large")), "small")
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.union(edges.select(F.col("b"), F.col("b")).distinct())
