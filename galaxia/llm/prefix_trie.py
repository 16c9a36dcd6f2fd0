"""Conversation prefix trie with a count-min screen.

Every prefix of a conversation is a node; its digest is the XOR of 64-bit hashes
of (turn, position), twice, so digests of all prefixes are running XORs.  All
digests are counted in a count-min sketch.  An estimate of one proves a prefix to
be in one conversation only: from there on its tail is a chain that is emitted
where it stands.  Only prefixes above it, possibly shared, are shuffled and
grouped exactly.  A sketch that is too small makes more prefixes "possibly
shared" and changes no result.

Sums over subtrees need no walk over levels: each node is put down to its
smallest member, and a node's subtree is what its members carry from its depth on.

No task holds a whole conversation or node.  Turns are numbered by range
partitions with one carry per boundary, running values by stretches of ``SPAN``
turns with the totals of earlier stretches added, so one conversation may hold a
third of all rows.  Ids of a node's ends are joined to long strings in parallel
and hashed in order as a stream.  The sketch has at most ``ROWS * MAX_CELLS`` bytes and is
memory-mapped from the shared folder.

Defined results: a NULL turn comes first; equal turn numbers are ordered by the
hash of role and text; repeated rows are turns of their own; rows without
conv_id belong to no conversation and make no node; NULL roles and texts are
empty; c % 20 has the sign of c; a conversation left without turns is a member
of the root only; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_root
from .common import NON_WS
from .sharedfiles import map_array, write_array

FAMILY = 20
MAX_HEAD = 3
#: Turns of one conversation that one window holds.
SPAN = 4096
#: Rows of the sketch, and its cells a row at most; a cell is one byte.
ROWS = 3
MAX_CELLS = 1 << 25
#: Cells of one stored part of the sketch.
PART = 1 << 20
NODE = ["depth", "p1", "p2"]


def turn_rows(df: DataFrame) -> DataFrame:
    """conv_id, turn, the hashes of role and text, and the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return (df.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("t1"),
                    F.xxhash64(F.lit("turn"), role, text).alias("t2"), F.regexp_count(text, F.lit(NON_WS + "+")).cast("long").alias("words")))


def numbered(turns: DataFrame) -> DataFrame:
    """The turns with ``pos``, from 1, within their conversation."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "t1", "t2"]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not len(b):
                continue
            conv = b["conv_id"].to_numpy()
            starts = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
            pos = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv)))) + 1
            if conv[0] == last:
                pos[conv == last] += seen
            last, seen = conv[-1], int(pos[-1])
            yield b.assign(part=part, pos=pos)

    sorted_rows = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "t1", "t2", "words")
    rows = materialize(sorted_rows.mapInPandas(count, "conv_id long, t1 long, t2 long, words long, part int, pos long"), "turns")
    held = rows.groupBy("part", "conv_id").agg(F.max("pos").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a conversation goes on over a boundary between partitions: a row per boundary at most
    carried = held.withColumn("ahead", F.sum("n").over(before)).where("ahead IS NOT NULL").select("part", "conv_id", "ahead")
    return (rows.join(F.broadcast(carried), ["part", "conv_id"], "left")
            .select("conv_id", (F.col("pos") + F.coalesce("ahead", F.lit(0))).alias("pos"), "t1", "t2", "words"))


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n: turns after rebuilding) and their turns
    (conv_id, depth, t1, t2, words, n)."""
    sizes = materialize(own.groupBy("conv_id").agg(F.max("pos").alias("own")), "conversation-sizes")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = sizes.select("conv_id", "own", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_HEAD + 1)).alias("h"))
    bases = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = (convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_own", F.lit(0))))
             .select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n")))
    convs = materialize(convs, "conversations")
    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= MAX_HEAD)).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").where("pos <= head").select("conv_id", F.col("pos").alias("depth"), "t1", "t2", "words", "n")
    rest = own.join(convs, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("depth"), "t1", "t2", "words", "n")
    return convs, first.unionByName(rest)


def running(rows: DataFrame, columns: dict, total, plus, backwards: bool = False) -> DataFrame:
    """Running totals over the depths of each conversation: name -> column.  Stretches
    of ``SPAN`` turns are windows of their own; totals of the earlier ones are added."""
    order = -F.col("depth") if backwards else F.col("depth")
    rows = rows.withColumns({**columns, "stretch": F.floor((F.col("depth") - 1) / SPAN) * (-1 if backwards else 1)})
    inside = Window.partitionBy("conv_id", "stretch").orderBy(order)
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "stretch").agg(*[total(c).alias(c) for c in columns])
    ahead = totals.select("conv_id", "stretch", *[total(c).over(before).alias(f"{c}_ahead") for c in columns])
    ahead = ahead.where(F.col(f"{next(iter(columns))}_ahead").isNotNull())
    found = rows.withColumns({c: total(c).over(inside) for c in columns}).join(ahead, ["conv_id", "stretch"], "left")
    return (found.withColumns({c: plus(F.col(c), F.coalesce(F.col(f"{c}_ahead"), F.lit(0))) for c in columns})
            .drop("stretch", *[f"{c}_ahead" for c in columns]))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, the prefix's digest p1, p2 and its parent's q1, q2, words, n."""
    marks = {"p1": F.xxhash64("t1", "t2", "depth"), "p2": F.xxhash64(F.lit("prefix"), "t1", "t2", "depth")}
    found = running(turns, marks, F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    return found.select("conv_id", "depth", "p1", "p2", *[F.col(p).bitwiseXOR(m).alias(q) for (p, m), q in zip(marks.items(), ("q1", "q2"), strict=True)], "words", "n")


# ------------------------------------------------------------------ count-min sketch

def _cells(p1: np.ndarray, p2: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cell of each digest in each row, numbered through."""
    a, b = p1.astype("uint64"), p2.astype("uint64") | np.uint64(1)
    for r in range(ROWS):
        yield ((a + np.uint64(r) * b) & np.uint64(cells - 1)).astype("int64") + r * cells


def sketch(rows: DataFrame, cells: int) -> dict[int, str]:
    """Count-min sketch of the digests, in parts: number -> path.  Cells count to two."""
    folder = f"{scratch_root(rows.sparkSession)}/prefix-sketch"
    part = min(PART, cells)

    def add(table, cell, n):
        table[cell] = np.minimum(table[cell].astype("int64") + n, 2)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(ROWS * cells, dtype="u1")
        for b in batches:
            for at in _cells(b["p1"].to_numpy(), b["p2"].to_numpy(), cells):
                add(table, *np.unique(at, return_counts=True))
        for k, piece in enumerate(table.reshape(-1, part)):
            if piece.any():
                yield pd.DataFrame({"part": [k], "held": [zlib.compress(piece.tobytes(), 1)]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, np.ndarray] = {}
        for b in batches:
            for k, held in zip(b["part"], b["held"], strict=True):
                table = tables.setdefault(k, np.zeros(part, dtype="u1"))
                np.minimum(table + np.frombuffer(zlib.decompress(held), dtype="u1"), 2, out=table)
        yield pd.DataFrame([(k, write_array(folder, f"part-{k}", t)) for k, t in tables.items()], columns=["part", "path"])

    parts = rows.select("p1", "p2").mapInPandas(count, "part int, held binary").repartition("part").mapInPandas(merge, "part int, path string")
    return {r["part"]: r["path"] for r in materialize(parts, "prefix-sketch-parts").collect()}     # ROWS * MAX_CELLS / PART rows at most


def estimates(rows: DataFrame, parts: dict[int, str], cells: int) -> DataFrame:
    """The rows with ``proven``: the sketch counts the prefix once."""
    part = min(PART, cells)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            least = np.full(len(b), 2, dtype="u1")
            for at in _cells(b["p1"].to_numpy(), b["p2"].to_numpy(), cells):
                order = np.argsort(at, kind="stable")
                cuts = np.flatnonzero(np.diff(at[order] // part)) + 1
                for own in np.split(order, cuts):
                    if len(own):
                        k = int(at[own[0]]) // part
                        least[own] = np.minimum(least[own], map_array(parts[k])[at[own] - k * part])
            yield b.assign(proven=least == 1)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(look, f"{kinds}, proven boolean")


# ------------------------------------------------------------------ nodes

def end_hashes(ends: DataFrame) -> DataFrame:
    """Per node: SHA-256 of the conv_ids that end there, ascending and comma-joined.
    Ids are joined in parallel, in sorted runs; a node's runs are hashed as a stream."""
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            node = b[NODE].to_numpy()
            cuts = np.flatnonzero((node[1:] != node[:-1]).any(axis=1)) + 1
            ids = b["conv_id"].tolist()
            at = [0, *cuts.tolist(), len(ids)] if ids else [0]
            rows = [(*node[i], ids[i], ",".join(map(str, ids[i:j]))) for i, j in zip(at, at[1:], strict=False)]
            yield pd.DataFrame(rows, columns=[*NODE, "first", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for b in batches:
            out = []
            for *node, ids in b[[*NODE, "ids"]].itertuples(index=False):
                if node == now:
                    state.update(b"," + ids.encode())
                else:
                    if now:
                        out.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends"])
        yield pd.DataFrame([(*now, state.hexdigest())] if now else [], columns=[*NODE, "ends"])

    key = "depth long, p1 long, p2 long"
    order = [*NODE, "conv_id"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(join, f"{key}, first long, ids string")
    return runs.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids").mapInPandas(digest, f"{key}, ends string")


def _root(df: DataFrame, *columns) -> DataFrame:
    return df.select(*[F.lit(0).cast("long").alias(c) for c in NODE], *columns)


def prefix_trie(df: DataFrame, cells: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    own = numbered(turn_rows(df))
    convs, turns = rebuilt(own)
    rows = materialize(prefixes(turns), "prefixes")
    n = rows.count()
    cells = cells or max(1 << 16, min(MAX_CELLS, 1 << (4 * n).bit_length()))
    screened = materialize(estimates(rows, sketch(rows, cells), cells), "screened")
    # below the first proven singleton of a conversation all prefixes are singletons
    first = screened.where("proven").groupBy("conv_id").agg(F.min("depth").alias("alone"))
    screened = materialize(screened.drop("proven").join(first, "conv_id", "left"), "prefixes-screened")
    shared = screened.where("alone IS NULL OR depth < alone")
    edge = screened.where("depth = alone")
    tails = screened.where("depth > alone")
    root_id = convs.agg(F.min("conv_id")).first()[0]

    exact = shared.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
                                      F.max("q1").alias("q1"), F.max("q2").alias("q2"))
    root = convs.groupBy().agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    nodes = materialize(exact.unionByName(_root(root, "n_convs", "conv_id", *[zero.alias(c) for c in ("words", "q1", "q2")])), "trie-nodes")

    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    kids = materialize(nodes.where("depth > 0").select(*up).unionByName(edge.select(*up)).groupBy(*NODE).agg(F.count("*").alias("n_children")), "trie-children")
    childless = nodes.where("depth > 0").join(kids, NODE, "left_anti").select("conv_id")
    leaves = materialize(childless.unionByName(edge.select("conv_id")), "trie-leaves")     # each under its smallest member, once
    saved = nodes.where("n_convs > 1 AND depth > 0").select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    carried = (shared.select("conv_id", *NODE).join(saved, ["conv_id", "depth"], "left")
               .join(leaves.withColumn("leaf", F.lit(1).cast("long")), "conv_id", "left")
               .select("conv_id", *NODE, F.coalesce("saved", zero).alias("saved"), F.coalesce("leaf", zero).alias("leaf")))
    carried = running(carried, {"saved": F.col("saved")}, F.sum, lambda a, b: a + b, backwards=True)
    ends = shared.where("depth = n").select(*NODE, "conv_id").unionByName(_root(convs.where("n = 0"), "conv_id"))

    def measures(table, **given):
        kinds = {"n_children": "long", "n_leaves": "long", "saved_tokens": "long", "ends": "string"}
        return table.select(*NODE, *[given.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
    found = (measures(kids, n_children=F.col("n_children"))
             .unionByName(measures(carried, n_leaves=F.col("leaf"), saved_tokens=F.col("saved")))
             .unionByName(measures(_root(leaves), n_leaves=F.lit(1)))
             .unionByName(measures(_root(saved, "saved"), saved_tokens=F.col("saved")))
             .unionByName(measures(end_hashes(ends), ends=F.col("ends"))))
    found = found.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    alone = F.when(F.col("depth") == F.col("n"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none)
    one_child = F.when(F.col("depth") == F.col("n"), zero).otherwise(F.lit(1).cast("long"))

    def result(table, parent, n_convs, n_children, n_leaves, saved_tokens, hashes):
        return table.select("conv_id", "depth", parent.alias("parent_conv_id"), *[c.cast("long").alias(k) for k, c in
                            (("n_convs", n_convs), ("n_children", n_children), ("n_leaves", n_leaves), ("saved_tokens", saved_tokens))], hashes.alias("ends_sha256"))
    known = nodes.join(found, NODE, "left").select(
        "conv_id", "depth", "q1", "q2", "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends", none).alias("ends"))
    singles = edge.select("conv_id", "depth", "q1", "q2", F.lit(1).cast("long").alias("n_convs"), one_child.alias("n_children"),
                          F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), alone.alias("ends"))
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    both = known.unionByName(singles).join(parents, ["depth", "q1", "q2"], "left")
    parent = F.when(F.col("depth") == 1, F.lit(root_id).cast("long")).otherwise(F.col("parent"))
    one = F.lit(1)
    return result(both, parent, F.col("n_convs"), F.col("n_children"), F.col("n_leaves"), F.col("saved_tokens"), F.col("ends")).unionByName(
        result(tails, F.col("conv_id"), one, one_child, one, zero, alone))
