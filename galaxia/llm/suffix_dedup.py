"""Suffix-array dedup by column-wise construction over many strings.

A byte goes if a 100-byte string that covers it starts earlier as well, in a
smaller document or earlier in its own.  Strings are found equal in the
Burrows-Wheeler transform of a collection and its common prefixes, built the
column-wise way: each round inserts one symbol of every string, last symbols
first, and updates both arrays, which are sequential files in the shared folder
that a round reads from front to end and writes anew.

Rounds over whole documents would be as many as the longest has bytes, and one
collection would be one task.  The corpus is therefore cut into short strings
that hold every 100-byte string once and bring equal ones together:

* The window's anchor is its ``CORE``-byte string of least hash (the first of
  equal ones).  Neighbouring windows with one anchor are a segment, of 100 to
  ``2 * MATCH - CORE`` bytes.  Equal windows have equal anchors.
* A first pass over the corpus finds anchors that occur more than once: their
  sorted hashes are arrays in the shared folder that the second pass memory-maps.
* Segments of shared anchors are compared by 128 bits of hashes, within a batch
  first; of equal ones the earliest stays for the construction, the others hold
  earlier strings only.
* Texts are fetched for segments whose anchor has several different ones, and
  dealt by anchor to collections of about ``COLLECTION`` segments.
* Before the construction segments are divided once, as short cores are shared by
  chance: windows that reach further left than right and those that do not have
  longer cores of their own.  Those of cores with more than ``LIMIT`` different
  segments are divided on, until a window is its own core, which has no second
  segment, so no collection grows with a frequent passage.

Defined results: documents are rows with different (doc_id, text), in order of
doc_id (a whole number; NULL first), then of the text's hash; rows repeated get
one result each, the same; NULL texts are empty; a text of any length is cut in
overlapping parts, so memory is bounded; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, scratch_root
from .common import slices, text_of
from .sharedfiles import delete_file, map_array, read_array, write_array

MATCH = 100
CORE = 32
#: Different segments an anchor has before it is divided, and about those of a collection.
LIMIT = 4096
COLLECTION = 20_000
#: Anchors of one stored array, about, and runs a task gathers before it hands them on.
STORED = 4_000_000
GATHERED = 300_000
#: Bytes that one array program works on.
STEP = 1 << 18
#: Fixed odd multipliers of the rolling hash and its last mixing.
_BASE, _SPREAD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)
_ID = ["known", "doc", "th"]
_ID_KIND = "known int, doc long, th long"


# ------------------------------------------------------------------ segments

def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def core_hashes(data: np.ndarray, core: int) -> np.ndarray:
    """Hash of each ``core`` bytes, by doubling: the hash of 2k bytes is made of two of k."""
    with np.errstate(over="ignore"):
        size, h, whole, at = 1, (data.astype("uint64") + np.uint64(1)) * _SPREAD, None, 0
        while True:
            if core & size:
                whole = h if whole is None else whole[:len(data) - at - size + 1] * _power(size) + h[at:at + len(data) - at - size + 1]
                at += size
            if at == core:
                break
            h = h[:-size] * _power(size) + h[size:]
            size *= 2
        whole = (whole ^ (whole >> np.uint64(29))) * _MIX
        return whole ^ (whole >> np.uint64(32))


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value of each ``width`` neighbours."""
    at, size = np.arange(len(values), dtype="int32"), 1
    while size < width:
        step = min(size, width - size)
        less = values[step:] < values[:-step]
        at, values = np.where(less, at[step:], at[:-step]), np.minimum(values[step:], values[:-step])
        size += step
    return at


class Runs:
    """Segments of documents: arrays row (of the batch), start, length, anchor (offset of
    the anchor in the segment) and h (the anchor's hash)."""

    def __init__(self, texts: list[bytes], match: int = MATCH, core: int = CORE):
        found = []
        room, held = [], 0
        for row, text in enumerate(texts):
            for at in range(0, max(len(text) - match + 1, 0), STEP):
                part = text[at:at + STEP + match - 1]
                if held + len(part) > 2 * STEP:
                    found.append(self._cut(room, match, core))
                    room, held = [], 0
                room.append((row, at, part))
                held += len(part)
        if room:
            found.append(self._cut(room, match, core))
        empty = [np.zeros(0, dtype=k) for k in ("int64", "int64", "int64", "int64", "uint64")]
        self.row, self.start, self.length, self.anchor, self.h = (np.concatenate(x) for x in zip(empty, *found, strict=True))

    @staticmethod
    def _cut(room, match, core):
        data = np.frombuffer(b"".join(p for _, _, p in room), dtype="u1")
        sizes = np.array([len(p) for _, _, p in room])
        ends = np.cumsum(sizes)
        h = core_hashes(data, core)
        anchor = first_least(h, match - core + 1)       # of the window that starts here
        part = np.repeat(np.arange(len(room)), sizes)[:len(anchor)]
        whole = np.arange(len(anchor)) + match <= ends[part]
        same = np.zeros(len(anchor), dtype=bool)
        same[1:] = (anchor[1:] == anchor[:-1]) & whole[:-1] & (part[1:] == part[:-1])
        starts = np.flatnonzero(whole & ~same)
        follows = np.append(same[1:] & whole[1:], False)
        lasts = np.flatnonzero(whole & ~follows)
        base = np.array([at for _, at, _ in room])[part[starts]] - (ends - sizes)[part[starts]]
        rows = np.array([r for r, _, _ in room])[part[starts]]
        return rows, starts + base, lasts - starts + match, anchor[starts] - starts, h[anchor[starts]]


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes], Runs]]:
    for b in slices(batches, "text"):
        texts = [t.encode("utf-8", "replace") for t in b["text"]]
        yield b, texts, Runs(texts)


def _keyed(df: DataFrame) -> DataFrame:
    """The rows with their document key: known, doc, th."""
    doc = F.col("doc_id").cast("long")
    text = text_of()
    return df.select("doc_id", doc.isNotNull().cast("int").alias("known"), F.coalesce(doc, F.lit(0)).cast("long").alias("doc"),
                     F.xxhash64(text).alias("th"), text.alias("text"))


# ------------------------------------------------------------------ first pass

def shared_anchors(docs: DataFrame, stored: int = STORED) -> tuple[int, dict[int, str]]:
    """Hashes of anchors that occur more than once, sorted, in arrays by their first
    bits: (bits, first bits -> path)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, int(2 * total / (MATCH - CORE) / stored).bit_length())
    folder = f"{scratch_root(docs.sparkSession)}/anchors"

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def out():
            h, times = np.unique(np.concatenate(held), return_counts=True)
            h = np.repeat(h, np.minimum(times, 2))          # twice is enough to be shared
            bucket = (h >> np.uint64(64 - bits)).astype("int64")
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            return pd.DataFrame({"bucket": bucket[first], "held": [x.tobytes() for x in np.split(h, first[1:])]})
        for _, _, runs in _batches(batches):
            held.append(runs.h)
            n += len(runs.h)
            if n > GATHERED:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        h = np.sort(np.frombuffer(b"".join(group["held"]), dtype="uint64"))
        again = np.unique(h[1:][h[1:] == h[:-1]])
        k = int(group["bucket"].iloc[0])
        return pd.DataFrame([(k, write_array(folder, f"anchors-{k}", again))], columns=["bucket", "path"])

    found = docs.select("text").mapInPandas(gather, "bucket long, held binary").groupBy("bucket").applyInPandas(merge, "bucket long, path string")
    return bits, {r["bucket"]: r["path"] for r in materialize(found, "anchor-files").collect()}     # one path per array


def _is_shared(h: np.ndarray, bits: int, paths: dict[int, str]) -> np.ndarray:
    order = np.argsort(h)
    own = h[order]
    found = np.zeros(len(h), dtype=bool)
    if not len(h):
        return found
    bucket = (own >> np.uint64(64 - bits)).astype("int64")
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for i, j in zip(cuts, [*cuts[1:], len(own)], strict=True):
        stored = map_array(paths[int(bucket[i])])
        at = np.searchsorted(stored, own[i:j])
        at[at == len(stored)] = 0
        found[order[i:j]] = (stored[at] == own[i:j]) if len(stored) else False
    return found


# ------------------------------------------------------------------ second pass

def segments(docs: DataFrame, bits: int, paths: dict[int, str]) -> DataFrame:
    """Segments of shared anchors: document key, start, length, anchor, h, d (hash of the
    segment's bytes) and ``again``: an earlier equal one is in the same batch."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, texts, runs in _batches(batches):
            keep = np.flatnonzero(_is_shared(runs.h, bits, paths))
            row, start, length = runs.row[keep], runs.start[keep], runs.length[keep]
            views = [memoryview(t) for t in texts]
            d = [xxhash.xxh3_64_intdigest(views[r][s:s + n]) for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            out = pd.DataFrame({c: b[c].to_numpy()[row] for c in _ID} | {"start": start, "length": length, "anchor": runs.anchor[keep],
                               "h": runs.h[keep].view("int64"), "d": np.array(d, dtype="uint64").view("int64")})
            yield _marked(out)

    kinds = f"{_ID_KIND}, start long, length long, anchor long, h long, d long, again boolean"
    return docs.select(*_ID, "text").mapInPandas(cut, kinds)


def _marked(rows: pd.DataFrame) -> pd.DataFrame:
    """``again`` for rows that are not the earliest of their (h, d) in the frame."""
    order = np.lexsort([rows[c].to_numpy() for c in ("start", "th", "doc", "known", "d", "h")])
    rows = rows.iloc[order]
    key, place = rows[["h", "d"]].to_numpy(), rows[["known", "doc", "th", "start"]].to_numpy()
    new = np.append(True, (key[1:] != key[:-1]).any(axis=1))[:len(rows)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, dtype=int)
    return rows.assign(again=(place != place[first]).any(axis=1))


def earliest(rows: DataFrame) -> DataFrame:
    """``again`` for all rows that are not the earliest of their (h, d), over all tasks."""
    place = F.struct(*_ID, "start")
    same = Window.partitionBy("h", "d")
    first = F.first(place).over(same.orderBy(*_ID, "start"))
    return rows.withColumn("again", ~place.eqNullSafe(first))


def contested(firsts: DataFrame) -> DataFrame:
    """Different segments of anchors that have several, with ``n``, how many."""
    several = firsts.groupBy("h").agg(F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high")).where("low <> high")
    return firsts.join(several.select("h", "n"), "h")


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted segments with their bytes."""
    lists = wanted.groupBy(*_ID).agg(F.collect_list(F.struct("start", "length", "anchor", "h", "n")).alias("parts"))
    joined = docs.select(*_ID, "text").join(lists, _ID)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for b in slices(batches, "text", 1_000_000):
            rows = []
            for known, doc, th, text, parts in zip(*(b[c] for c in [*_ID, "text", "parts"]), strict=True):
                if (known, doc, th) == before:      # a repeated row
                    continue
                before, data = (known, doc, th), text.encode("utf-8", "replace")
                rows += [(known, doc, th, p["start"], p["anchor"], p["h"], p["n"], data[p["start"]:p["start"] + p["length"]]) for p in parts]
            yield pd.DataFrame(rows, columns=[*_ID, "start", "anchor", "h", "n", "bytes"])

    return joined.mapInPandas(cut, f"{_ID_KIND}, start long, anchor long, h long, n long, bytes binary")


def halved(rows: DataFrame) -> DataFrame:
    """Segments whose windows start ``low`` to ``high`` bytes before the anchor, divided in
    two by that distance.  All windows of a half hold the bytes from the furthest start
    to the nearest end, its core, whose hash is the new anchor's."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for known, doc, th, start, anchor, low, high, data in zip(*(b[c] for c in [*_ID, "start", "anchor", "low", "high", "bytes"]), strict=True):
                middle = (low + high) // 2
                for near, far in ((low, middle), (middle + 1, high)):
                    # windows start at ``anchor - far`` to ``anchor - near`` of the segment, inside it
                    i, j = max(anchor - far, 0), min(anchor - near, len(data) - MATCH)
                    if i > j:
                        continue
                    core = data[anchor - near:anchor - far + MATCH]
                    part = data[i:j + MATCH]
                    h = xxhash.xxh3_64_intdigest(core, seed=1 + near * MATCH + far) - 2**63
                    out.append((known, doc, th, start + i, anchor - i, near, far, h, xxhash.xxh3_64_intdigest(part) - 2**63, part))
            yield pd.DataFrame(out, columns=[*_ID, "start", "anchor", "low", "high", "h", "d", "bytes"])

    return rows.mapInPandas(cut, f"{_ID_KIND}, start long, anchor long, low int, high int, h long, d long, bytes binary")


# ------------------------------------------------------------------ collections

class Collection:
    """Burrows-Wheeler transform and common prefixes of many byte strings, column by column.

    Symbols are bytes plus one; 0 ends a string.  (UTF-8 has no byte 255.)  The ends
    of two strings differ, so no common prefix goes past one."""

    def __init__(self, strings: list[bytes], folder: str):
        self.strings, self.size = strings, len(strings)
        self.lengths = np.array([len(s) for s in strings])
        columns = np.zeros((int(self.lengths.max()) + 1, self.size), dtype="u1")     # row j: the symbol before the last j
        for i, s in enumerate(strings):
            columns[:len(s), i] = np.frombuffer(s, dtype="u1")[::-1] + 1
        path = write_array(folder, "columns", np.vstack([columns[0], np.zeros(self.size, dtype="u1")]))
        place = np.arange(self.size)             # of each string's suffix inserted last
        for j in range(1, len(columns)):
            active = np.flatnonzero(self.lengths >= j)
            symbols, common = read_array(path)
            delete_file(path)
            symbols, common, place[active] = self._insert(symbols, common, place[active], columns[j, active], int((self.lengths < j).sum()))
            path = write_array(folder, "columns", np.vstack([symbols, common]))
        self.symbols, self.common = read_array(path)
        delete_file(path)

    def _insert(self, symbols, common, place, following, ended):
        """One round: the suffix of each active string grows by the symbol at ``place``."""
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(len(order), dtype="int32")
        rank[order] = np.arange(len(order), dtype="int32")
        at = rank[place]                                    # among all symbols; ends come first
        new = at + self.size - ended
        # common prefixes with the neighbours: one more than the least between their rests
        touched = np.sort(np.concatenate([at, at + 1]))
        touched = touched[np.diff(touched, append=len(order)) > 0]      # once each, and none past the last
        near = touched[touched > ended]
        near = near[symbols[order[near]] == symbols[order[near - 1]]]
        near = near[np.argsort(order[near])[::-1]]          # from the back: no gaps to reduce
        found = np.zeros(len(order), dtype="u1")
        if len(near):
            pairs = np.empty(2 * len(near), dtype="int64")
            pairs[0::2], pairs[1::2] = order[near - 1] + 1, order[near] + 1
            least = np.minimum.reduceat(np.append(common, np.uint8(0)), pairs)[0::2]
            found[near] = np.minimum(least, MATCH - 1) + 1
        grown = len(symbols) + len(new)
        old = np.ones(grown, dtype=bool)
        old[new] = False
        out_symbols, out_common = np.empty(grown, dtype="u1"), np.empty(grown, dtype="u1")
        out_symbols[old], out_common[old] = symbols, common
        out_symbols[new] = following
        out_common[touched + self.size - ended] = found[touched]
        return out_symbols, out_common, new

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window of MATCH bytes: its string, its start, and the number of its class."""
        order = np.argsort(self.symbols, kind="stable")
        rank = np.empty(len(order), dtype="int64")
        rank[order] = np.arange(len(order))
        kind = np.cumsum(self.common < MATCH)
        place, found = np.arange(self.size), []
        for j in range(1, int(self.lengths.max()) + 1):
            active = np.flatnonzero(self.lengths >= j)
            place[active] = rank[place[active]]
            if j >= MATCH:
                found.append((active, self.lengths[active] - j, kind[place[active]]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def repeated_parts(rows: pd.DataFrame, folder: str) -> pd.DataFrame:
    """Bytes [start, end) of documents whose windows occur earlier in the collection."""
    rows = rows.sort_values([*_ID, "start"], ignore_index=True)
    string, at, kind = Collection(rows["bytes"].tolist(), folder).windows()
    start = rows["start"].to_numpy()[string] + at
    document = np.cumsum((rows[_ID] != rows[_ID].shift()).any(axis=1).to_numpy()) - 1
    doc = document[string]
    order = np.lexsort((start, doc, kind))
    first = order[np.flatnonzero(np.diff(kind[order], prepend=-1))]
    which = np.searchsorted(kind[first], kind)      # classes ascend in ``first``
    gone = np.flatnonzero((doc != doc[first][which]) | (start != start[first][which]))
    gone = gone[np.lexsort((start[gone], string[gone]))]
    cut = np.flatnonzero((np.diff(string[gone], prepend=-1) != 0) | (np.diff(start[gone], prepend=-2) != 1))
    last = np.append(cut[1:], len(gone))[:len(cut)] - 1
    of = rows[_ID].iloc[string[gone[cut]]].reset_index(drop=True)
    return of.assign(start=start[gone[cut]], end=start[gone[last]] + MATCH)


def collections(rows: DataFrame, per: int = COLLECTION) -> DataFrame:
    """Repeated parts of contested segments; each collection has all of its anchors' segments."""
    folder = f"{scratch_root(rows.sparkSession)}/columns"
    many = max(1, -(-rows.count() // per))
    dealt = rows.select(*_ID, "start", "bytes", F.pmod(F.xxhash64("h"), F.lit(many)).alias("collection"))
    return dealt.groupBy("collection").applyInPandas(lambda g: repeated_parts(g.drop(columns="collection"), folder), f"{_ID_KIND}, start long, end long")


def repeated(docs: DataFrame, limit: int = LIMIT, per: int = COLLECTION, stored: int = STORED) -> DataFrame:
    """Parts [start, end) of keyed documents that are covered by earlier strings."""
    def whole(rows, size):
        return rows.where("again").select(*_ID, "start", (F.col("start") + size).alias("end"))
    found = materialize(segments(docs, *shared_anchors(docs, stored)), "segments")
    parts = [whole(found, F.col("length"))]
    found = materialize(earliest(found.where("NOT again").drop("again")), "segments-first")
    parts.append(whole(found, F.col("length")))
    firsts = found.where("NOT again").drop("again").dropDuplicates(["h", "d"])
    texts = materialize(fetched(docs, contested(firsts)), "segment-texts")
    many = texts.withColumns({"low": F.lit(0), "high": F.lit(MATCH - CORE)})
    while not many.isEmpty():       # seven rounds at most, as a round halves the distances
        half = materialize(earliest(halved(many.select(*_ID, "start", "anchor", "low", "high", "bytes"))), "segments-halved")
        parts.append(whole(half, F.octet_length("bytes")))
        now = materialize(contested(half.where("NOT again").drop("again").dropDuplicates(["h", "d"])), "segments-contested")
        parts.append(collections(now.where(F.col("n") <= limit), per))
        many = now.where(F.col("n") > limit)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suffix_dedup(df: DataFrame, limit: int = LIMIT, per: int = COLLECTION, stored: int = STORED) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) and the spans."""
    docs = _keyed(df)
    parts = materialize(repeated(docs, limit, per, stored), "repeated-parts")
    lists = parts.groupBy(*_ID).agg(F.collect_list(F.struct("start", "end")).alias("parts"))
    joined = docs.withColumn("doc_id", F.col("doc_id").cast("string")).join(lists, _ID, "left").select("doc_id", "text", "parts")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches, "text", 1_000_000):
            rows = []
            for doc_id, text, parts in zip(b["doc_id"], b["text"], b["parts"], strict=True):
                data = text.encode("utf-8", "replace")
                spans = _union([(p["start"], p["end"]) for p in parts] if parts is not None else [])
                kept, at = [], 0
                for s, e in spans:
                    kept.append(data[at:s])
                    at = e
                kept = b"".join([*kept, data[at:]])
                rows.append((doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, [f"{s}:{e}" for s, e in spans]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    kinds = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<string>"
    return joined.mapInPandas(remove, kinds).withColumn("doc_id", F.col("doc_id").cast(df.schema["doc_id"].dataType))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]
