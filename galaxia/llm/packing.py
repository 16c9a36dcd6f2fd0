"""Best-fit packing by minimum bin slack.

Documents become pieces of 1 to ``CAPACITY`` tokens.  Bins depend on lengths
alone, so the plan is made from the histogram of lengths: at most ``CAPACITY``
numbers, whatever the corpus.  Per bin, a bitset subset-sum dynamic program over
the lengths still available finds the fullest feasible combination around the
longest one; it is removed, as many times over as the counts allow.  The plan is
a short table (length, from-rank, bin, offset); pieces are ranked within their
length in Spark and look their place up.

Ranks are dealt by (length, salt), a length having a salt for every ``GROUP`` of
its pieces, so one that a third of all pieces have is spread over many tasks.

Defined results: NULL or empty text is the one end id; only documents longer
than the capacity are cut; repeated rows are packed each; a NULL doc_id is kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import wordcodec
from .common import map_documents, slices, text_of

CAPACITY = 4096
END_ID = 1
#: Pieces of one length that one task ranks together, about.
GROUP = 4096


def pieces(df: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    path = path or wordcodec.vocabulary_path()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = wordcodec.codec(path)
        for b in slices(batches, "text"):
            rows = []
            for doc_id, ids in zip(b["doc_id"], c.encode_texts(b["text"].tolist()), strict=True):
                ids = np.append(ids.astype("<u4"), np.uint32(END_ID))
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    rows.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes()), *([part.astype("int64")] * with_ids)))
            yield pd.DataFrame(rows, columns=columns)

    fields = "piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return map_documents(df.select("doc_id", text_of().alias("text")), cut, fields)


def fullest(slack: int, counts: dict[int, int]) -> list[tuple[int, int]]:
    """The fullest feasible combination of the lengths at hand within ``slack``:
    (length, how many).  Bit s of the set is on where sum s can be reached."""
    reach, mask, steps = 1, (1 << (slack + 1)) - 1, []
    for length in sorted((x for x in counts if x <= slack), reverse=True):
        left, part = min(counts[length], slack // length), 1
        while left:                       # 1, 2, 4, ... copies at a time
            k = min(part, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left, part = left - k, part * 2
        if reach >> slack & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            total -= length * k
            taken[length] = taken.get(length, 0) + k
    return sorted(taken.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Rows (length, rank, bin, uses, offset): pieces of ``length`` from ``rank`` on
    go ``uses`` to a bin, from ``bin`` on, at ``offset``."""
    counts = {k: n for k, n in histogram.items() if n}
    given, rows, bins = dict.fromkeys(counts, 0), [], 0
    order = sorted(counts)
    while order:
        longest = order[-1]
        if longest not in counts:
            order.pop()
            continue
        counts[longest] -= 1              # the anchor itself is not available twice
        taken = dict(fullest(capacity - longest, {k: n for k, n in counts.items() if n}))
        counts[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(counts[k] // use for k, use in taken.items())
        offset = 0
        for length, use in sorted(taken.items(), reverse=True):
            rows.append((length, given[length], bins, use, offset))
            given[length] += use * times
            counts[length] -= use * times
            offset += length * use
            if not counts[length]:
                del counts[length]
        bins += times
    return pd.DataFrame(rows, columns=["length", "rank", "bin", "uses", "offset"])


def ranked(table: DataFrame, columns: list[str], histogram: dict[int, int]) -> DataFrame:
    """The rows with ``rank``, from 0, within their length."""
    salts = [(k, -(-n // GROUP)) for k, n in histogram.items()]     # a row per length: at most CAPACITY
    salts = F.broadcast(table.sparkSession.createDataFrame(salts or [(0, 1)], "length long, salts long"))
    salted = (table.join(salts, "length")
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))))
    ahead = (salted.groupBy("length", "salt").count()
             .withColumn("ahead", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")))
    ahead = materialize(ahead.select("length", "salt", "ahead"), "length-ranks")
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    return (salted.withColumn("within", within).join(ahead, ["length", "salt"])
            .select(*columns, (F.col("ahead") + F.col("within") - 1).alias("rank")))


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, length, ids_crc32 and any more) with sequence_id and offset."""
    table = materialize(table, "pieces")
    columns = table.columns
    histogram = {r["length"]: r["count"] for r in table.groupBy("length").count().collect()}
    p = plan(histogram, capacity).sort_values(["length", "rank"])
    key = (p["length"].to_numpy("int64") << 45) | p["rank"].to_numpy("int64")
    bins, uses, offsets = (p[c].to_numpy("int64") for c in ("bin", "uses", "offset"))
    shared = table.sparkSession.sparkContext.broadcast((key, bins, uses, offsets))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, bins, uses, offsets = shared.value
        for b in batches:
            length = b["length"].to_numpy("int64")
            own = (length << 45) | b["rank"].to_numpy("int64")
            at = np.searchsorted(key, own, side="right") - 1
            nth = own - key[at]
            yield b.drop(columns="rank").assign(sequence_id=bins[at] + nth // uses[at],
                                                offset=offsets[at] + nth % uses[at] * length)

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in table.schema if f.name != "doc_id")
    return map_documents(ranked(table, columns, histogram), place, f"{kinds}sequence_id long, offset long").select(*columns, "sequence_id", "offset")


def best_fit_packing(df: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(df, path, capacity), capacity)
