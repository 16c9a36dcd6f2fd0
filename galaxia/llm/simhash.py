"""SimHash near-dedup through a byte-position inverted index.

A 64-bit fingerprint is eight bytes.  Two fingerprints that differ in at most
``MAX_BITS`` = 4 bits differ in at most four bytes, so at least four positional
bytes agree: the guaranteed minimum.  Posting lists are kept for sets of three
byte positions rather than single ones, twenty sets chosen so that any four
positions contain one of them (a Turan system): a pair with four agreeing bytes
meets in some list, and a list holds one in 2^24 of unrelated fingerprints.
Within a list, pairs are tallied (agreeing bytes), those under four dropped, and
the rest verified bit by bit.

Copies collapse first: only distinct fingerprints are indexed.  A list longer
than ``BLOCK`` is compared block against block in separate tasks.  A list does
not emit its pairs but a spanning forest of its verified links, at most one row
per member, and pairs already connected are not compared again; no link between
different fingerprints is lost to the components.

Defined results: NULL or empty text, or one without a word, has fingerprint zero
and links like any other; fewer than four words are one shingle; repeated rows
share a fingerprint; a NULL id is never a component's smallest while it has
another; an empty table gives an empty result; other columns are ignored unless
carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_documents, packed, text_of
from .components import connected_components

SHINGLE = 4
MAX_BITS = 4
MIN_BYTES = 8 - MAX_BITS
SEED = 42
BLOCK = 4096


def fingerprint(text: str, width: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends[width - 1:].tolist() or [len(joined)]
    cut = [joined[a:b] for a, b in zip(starts, ends, strict=False)]
    hashes = np.fromiter(map(xxh64_intdigest, cut, repeat(SEED)), ">u8", len(cut))
    total = np.zeros(64, np.int64)
    for i in range(0, len(cut), 1 << 16):
        total += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(cut)).view(">u8")[0])


def fingerprints(df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, the carried columns and ``fp``, the fingerprint as a signed long."""
    carry = carry or []
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*carry).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter(map(fingerprint, b["text"]), np.uint64, len(b)).view(np.int64)
            yield b.drop(columns="text").assign(fp=fp)

    return map_documents(df.select("doc_id", *carry, text_of().alias("text")), run, f"{kinds}fp long")


def position_sets() -> list[tuple[int, int, int]]:
    """Twenty triples of the eight byte positions such that any four hold one: three
    groups; all of a group, or two of a group and one of the next."""
    group = {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2}

    def taken(t):
        n = [sum(group[p] == g for p in t) for g in range(3)]
        return 3 in n or any(n[g] == 2 and n[(g + 1) % 3] == 1 for g in range(3))
    return [t for t in combinations(range(8), 3) if taken(t)]


def postings(fps: DataFrame) -> DataFrame:
    """key (which positions, which bytes), fp."""
    def byte(p):
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    keys = [F.lit(k << 24).bitwiseOR(F.shiftleft(byte(a), 16)).bitwiseOR(F.shiftleft(byte(b), 8)).bitwiseOR(byte(c)).cast("int")
            for k, (a, b, c) in enumerate(position_sets())]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def posting_lists(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Lists of at least two fingerprints, none longer than two blocks."""
    rows = postings(fps)
    long = materialize(rows.groupBy("key").count().where(F.col("count") > block)
                       .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "long-lists")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.join(long, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return (rows.groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
            .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))


def _roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least member) after joining a[i] with b[i]."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]


def forest(lists: list[np.ndarray], max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all lists: (fingerprint, a linked or connected smaller one)."""
    fps = np.concatenate(lists).view(np.uint64)
    which = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    label = np.arange(len(fps))
    here = np.arange(len(fps))
    for step in range(1, max(map(len, lists))):
        here = here[:np.searchsorted(here, len(fps) - step)]
        here = here[which[here] == which[here + step]]     # pairs that far apart in one list
        if not len(here):
            break
        apart = here[label[here] != label[here + step]]
        x = fps[apart] ^ fps[apart + step]
        agreeing = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        apart, x = apart[agreeing >= 8 - max_bits], x[agreeing >= 8 - max_bits]
        apart = apart[np.bitwise_count(x) <= max_bits]
        if len(apart):
            label = _roots(label, apart, apart + step)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved].view(np.int64), fps[label[moved]].view(np.int64)


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose components are those of all links within MAX_BITS."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lists = [np.asarray(x, np.int64) for x in b["fps"]]
            if lists:
                a, c = forest(lists)
                yield pd.DataFrame({"a": a, "b": c}).drop_duplicates()
    return posting_lists(fps, block).select("fps").mapInPandas(run, "a long, b long")


def near_duplicates(df: DataFrame, carry: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, the carried columns, fp, fingerprint (16 hex digits), root (the
    component's own key) and component_id, its smallest doc_id."""
    carry = carry or []
    docs = materialize(fingerprints(df, carry), "fingerprints")
    fps = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = connected_components(links(fps.select("fp"), block))
    linked = fps.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    linked = materialize(linked.select("fp", "root", "least_id"), "rooted")
    least = materialize(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    classes = materialize(linked.join(least, "root").select("fp", "root", "component_id"), "classes")
    return docs.join(classes, "fp").select("doc_id", *carry, "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                           "root", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns."""
    rows = packed(docs)
    found = near_duplicates(rows, ["rk"])
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk")
    kept = found.groupBy("root").agg(F.min(first).alias("k")).select(F.col("k.doc_id").alias("id"), F.col("k.rk").alias("rk"))
    same = (F.col("d.rk") == F.col("k.rk")) & F.col("d.doc_id").eqNullSafe(F.col("k.id"))
    return (rows.alias("d").join(kept.alias("k"), same, "left_semi")
            .dropDuplicates(["rk", "doc_id"]).select("row.*"))
