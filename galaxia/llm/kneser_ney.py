"""Interpolated modified Kneser-Ney trigram model.

Counting (Spark): tasks count words, then bigrams, then trigrams, of their own
documents and send sorted runs of 64-bit hashes with counts, one run per hash range;
a range is merged in one task.  Ranges split the hash space, not the words, so a
frequent word or context is spread over all of them, and their number grows with the
corpus: a task's share stays the same.

Storing: each range is a sorted array in the shared folder.  A word's hash has 64
bits, made of its bytes for all words of a chunk at once, and its id is its rank; a bigram's hash is a one-to-one mix of
its two ids, a trigram's one of its context's rank among the bigrams and its last
word's id, so a lookup in a sorted hash array is exact.  Context statistics (how many
followers were seen once, twice, more often) and continuation counts are arrays
beside the words and beside the bigrams.

Scoring: workers memory-map the arrays and look sorted batches of hashes up.

    P(w|uv) = max(c(uvw) - D(c), 0) / c(uv) + (D1 N1(uv) + D2 N2(uv) + D3 N3+(uv)) / c(uv) * P2(w|v)
    P2(w|v) = the same over continuation counts of bigrams, interpolated with P1(w)
    P1(w)   = the same over continuation counts of words, interpolated with 1 / (V + 1)

with three discounts at each level from the counts of counts.  Nothing precedes the
begin, so bigrams that start with it keep their plain count and a document's first
token is given by P2.  An unknown word is one of the V + 1; an unknown context leaves
the next lower level.  ``order`` 2 ends at bigrams, with plain counts.

Defined results: NULL or empty text is one token, the end; repeated rows count and
score each; a NULL id is not held out; without training documents every
token has probability 1 / (V + 1) with V = 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_root
from .common import fold, map_documents, text_of
from .sharedfiles import map_array, write_array

#: Tokens a bigram range holds about.
RANGE_TOKENS = 1 << 22
#: Tokens a task counts before it sends a run.
RUN_TOKENS = 1 << 22
#: Code points a task counts or scores at a time.
CHUNK_POINTS = 2_000_000
ORDER = 3
UNKNOWN = (1 << 32) - 1
#: Bytes of a word that are hashed in arrays; longer words are hashed one by one.
HASH_BYTES = 64
# The lowest bytes of a number.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_I1, _I2 = (np.uint64(pow(int(m), -1, 1 << 64)) for m in (_M1, _M2))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers (xor-shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    def back(x, s):   # undo x ^ x >> s
        y = x
        for _ in range(64 // s):
            y = x ^ (y >> np.uint64(s))
        return y
    return back(back(back(x, 31) * _I2, 27) * _I1, 30)


def word_hash(words: pa.Array | list[bytes]) -> np.ndarray:
    """64-bit hashes of words.  Eight bytes of all words are mixed in at a time, after the
    length; words of more than ``HASH_BYTES`` go through XXH64 one by one."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, offsets, body = (pa.array(words, pa.large_binary()) if isinstance(words, list) else words).buffers()
    offsets, data = np.frombuffer(offsets, np.int64)[:len(words) + 1], np.frombuffer(body, np.uint8)
    starts, sizes = offsets[:-1], np.diff(offsets)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))    # the eight bytes from each place on
    out = mix(sizes.astype(np.uint64))
    some = np.flatnonzero(sizes <= HASH_BYTES)
    for done in range(0, HASH_BYTES, 8):
        some = some[sizes[some] > done]
        block = eight[starts[some] + done] & _LOW[np.minimum(sizes[some] - done, 8)]
        out[some] = mix(out[some] ^ block)
    if len(some := np.flatnonzero(sizes > HASH_BYTES)):
        from xxhash import xxh64_intdigest
        out[some] = [xxh64_intdigest(data[a:b]) for a, b in zip(offsets[some].tolist(), offsets[some + 1].tolist(), strict=True)]
    return out


def split(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, one after the other, and how many each text has."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join(raw).lower(), np.uint8)
    solid = (data != 0x20) & (data - np.uint8(0x09) > 4)    # 09 to 0D and 20 are between words
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])])
    past = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    return words, np.diff(np.searchsorted(starts, past), prepend=0)


# ---------------------------------------------------------------- sorted runs


def pack_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run, small: differences of keys and counts, bytes of one place together."""
    gaps = np.diff(keys, prepend=np.zeros(1, keys.dtype)).astype("<u8")
    body = gaps.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack_run(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), np.uint8)
    n = len(body) // 12
    gaps = np.ascontiguousarray(body[:8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.ascontiguousarray(body[8 * n:].reshape(4, n).T).view("<u4").ravel()


def merge_runs(runs) -> tuple[np.ndarray, np.ndarray]:
    """One sorted run of many, counts of equal keys added."""
    parts = [unpack_run(bytes(r)) for r in runs]
    return add_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys sorted, counts of equal ones added."""
    order = np.argsort(keys, kind="stable")    # which merges what is sorted already
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def write_counts(folder: str, name: str, table: np.ndarray) -> list[str]:
    """Counts by position (last axis) as bytes, and positions with a count of 255 or more whole."""
    large = np.flatnonzero((table >= 255).any(axis=0))
    return [write_array(folder, name, np.minimum(table, 255).astype(np.uint8).T.copy()),
            write_array(folder, f"{name}-large", np.concatenate([large[None], table[:, large]]).astype(np.int64))]


def read_counts(small: np.ndarray, large: np.ndarray, pos: np.ndarray) -> np.ndarray:
    out = small[pos].astype(np.int64)
    big = np.flatnonzero((out == 255).any(axis=1))
    if len(big):
        out[big] = large[1:, np.searchsorted(large[0], pos[big])].T
    return out


def _shift(ranges: int) -> np.uint64:
    return np.uint64(64 - (ranges.bit_length() - 1))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges are powers of two: the top bits of the hash."""
    return (keys >> _shift(ranges)).astype(np.int64) if ranges > 1 else np.zeros(len(keys), np.int64)


def ascending(values: np.ndarray) -> np.ndarray:
    """The order that sorts the whole numbers, which often are sorted already; equal
    ones stay in order.  Their top bits are sorted with the places below them, as numbers
    sort several times faster than places."""
    if (values[1:] >= values[:-1]).all():
        return np.arange(len(values))
    places = len(values).bit_length()
    low = values.min()
    drop = np.uint64(max(0, (int(values.max()) - int(low)).bit_length() + places - 64))
    packed = (values - low).astype(np.uint64) >> drop << np.uint64(places) | np.arange(len(values), dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << places) - 1)).astype(np.int64)
    if drop:    # numbers that differ in lower bits only
        top, got = packed >> np.uint64(places), values[order]
        late = np.unique(top[:-1][got[1:] < got[:-1]])
        if len(late) > 1000:
            return np.argsort(values, kind="stable")
        for a, b in zip(np.searchsorted(top, late), np.searchsorted(top, late, side="right"), strict=True):
            order[a:b] = order[a:b][np.argsort(got[a:b], kind="stable")]
    return order


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct whole numbers, sorted, and the place of every one among them."""
    order = ascending(values)
    values = values[order]
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    places = np.empty(len(values), np.int64)
    places[order] = np.cumsum(first) - 1
    return values[first], places


def starts_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted keys; the last is their number."""
    first = np.arange(1, ranges, dtype=np.uint64) << _shift(ranges) if ranges > 1 else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, first), [len(keys)]]).astype(np.int64)


def _runs(keys: np.ndarray, counts: np.ndarray, ranges: int) -> pd.DataFrame:
    cuts = starts_of(keys, ranges)
    rows = [(r, pack_run(keys[a:b], counts[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    return pd.DataFrame(rows, columns=["range", "run"])


def _power(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1, n)))))


# ---------------------------------------------------------------- the model


class Model:
    """What the driver knows of the stored arrays (paths by range and a few sums);
    workers map the arrays when they first look something up."""

    def __init__(self):
        self.word_files: list[tuple[str, str] | None] = []
        self.word_starts = np.zeros(1, np.int64)     # first id of each range; the last is the number of words
        self.order = ORDER
        self.bigram_files: list[tuple[str, str, str] | None] = []
        self.bigram_starts = np.zeros(1, np.int64)   # first rank of each range
        self.bigram_stats: list[tuple[str, str] | None] = []
        self.trigram_files: list[tuple[str, str, str] | None] = []
        self.stat_files: list[str | None] = []
        self.n = self.vocabulary = self.documents = 0
        self.d3 = self.d2 = self.d1 = (0.5, 1.0, 1.5)
        self.continuations = 0
        self.gamma = 1.0

    @property
    def end(self) -> int:
        return int(self.word_starts[-1])

    @property
    def begin(self) -> int:
        return self.end + 1

    # ids

    def ids_of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), UNKNOWN, np.uint32)
        for sel, (keys,), r in self._each(hashes, [f and f[:1] for f in self.word_files]):
            at = np.minimum(np.searchsorted(keys, hashes[sel]), len(keys) - 1)
            hit = keys[at] == hashes[sel]
            out[sel[hit]] = (at[hit] + self.word_starts[r]).astype(np.uint32)
        return out

    @staticmethod
    def _each(hashes: np.ndarray, files: list):
        """(positions of the hashes of a range in hash order, its arrays, range)."""
        order = ascending(hashes)
        cuts = starts_of(hashes[order], len(files)) if files else np.zeros(1, np.int64)
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a and files[r]:
                yield order[a:b], [map_array(p) for p in files[r]], r

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end, and the tokens of each text."""
        words, sizes = split(texts)
        hashes, at = distinct(word_hash(words))
        ids = self.ids_of(hashes)[at]
        return np.insert(ids, np.cumsum(sizes), np.uint32(self.end)), sizes + 1

    def contexts(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[np.cumsum(sizes) - sizes] = self.begin
        return before

    # counts

    def stats(self, ids: np.ndarray) -> np.ndarray:
        """For each id: count, continuation count, followers seen once, twice, more often
        (by their own continuation counts below the highest order), their sum."""
        out = np.zeros((len(ids), 6), np.int64)
        known = ids != UNKNOWN
        own = np.searchsorted(self.word_starts, ids, side="right") - 1
        order = ascending(own)
        cuts = np.searchsorted(own[order], np.arange(len(self.stat_files) + 1))
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a and self.stat_files[r]:
                sel = order[a:b][known[order[a:b]]]
                out[sel] = map_array(self.stat_files[r])[ids[sel] - self.word_starts[r]]
        return out

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of bigrams by their hashes; -1 where there is none."""
        out = np.full(len(keys), -1, np.int64)
        for at, (hashes,), r in self._each(keys, [f and f[:1] for f in self.bigram_files]):
            pos = np.minimum(np.searchsorted(hashes, keys[at]), len(hashes) - 1)
            hit = hashes[pos] == keys[at]
            out[at[hit]] = pos[hit] + self.bigram_starts[r]
        return out

    def pair_ranks(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), -1, np.int64)
        sel = np.flatnonzero((before != UNKNOWN) & (ids != UNKNOWN))
        out[sel] = self.ranks(pair_keys(before[sel], ids[sel]))
        return out

    def _ranked(self, ranks: np.ndarray, files: list):
        """(positions of the ranks of a bigram range, its arrays, places in them)."""
        order = ascending(ranks)
        cuts = np.searchsorted(ranks[order], self.bigram_starts)
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a and files[r]:
                yield order[a:b], [map_array(p) for p in files[r]], ranks[order[a:b]] - self.bigram_starts[r]

    def bigram_counts(self, ranks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ranks), np.int64)
        for at, (small, large), pos in self._ranked(ranks, [f and f[1:] for f in self.bigram_files]):
            out[at] = read_counts(small, large, pos)[:, 0]
        return out

    def bigram_table(self, ranks: np.ndarray) -> np.ndarray:
        """For each bigram: continuation count, followers seen once, twice, more often."""
        out = np.zeros((len(ranks), 4), np.int64)
        for at, (small, large), pos in self._ranked(ranks, self.bigram_stats):
            out[at] = read_counts(small, large, pos)
        return out

    def second(self, ranks: np.ndarray) -> np.ndarray:
        """The last word of each bigram."""
        out = np.zeros(len(ranks), np.uint64)
        for at, (keys,), pos in self._ranked(ranks, [f and f[:1] for f in self.bigram_files]):
            out[at] = unmix(keys[pos]) & np.uint64(UNKNOWN)
        return out

    def bigrams(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.bigram_counts(self.pair_ranks(before, ids))

    @property
    def word_bits(self) -> int:
        return int(self.begin).bit_length()

    def trigram_keys(self, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return mix(context.astype(np.uint64) << np.uint64(self.word_bits) | ids.astype(np.uint64))

    def trigrams(self, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Counts of words after the bigrams of these ranks."""
        out = np.zeros(len(ids), np.int64)
        sel = np.flatnonzero((context >= 0) & (ids != UNKNOWN))
        keys = self.trigram_keys(context[sel], ids[sel])
        for at, (hashes, small, large), _ in self._each(keys, self.trigram_files):
            pos = np.minimum(np.searchsorted(hashes, keys[at]), len(hashes) - 1)
            hit = hashes[pos] == keys[at]
            out[sel[at[hit]]] = read_counts(small, large, pos[hit])[:, 0]
        return out

    # probabilities

    def log10(self, before: np.ndarray, ids: np.ndarray, context: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 P of each token, its unsmoothed-by-context base log10, and its count.
        ``context`` holds ranks of the bigrams before the tokens (-1: none)."""
        words, at = np.unique(np.concatenate([ids, before]), return_inverse=True)
        pairs, pair_at = np.unique(self.pair_ranks(before, ids), return_inverse=True)
        some, some_at = np.unique(np.full(1, -1) if context is None else context, return_inverse=True)
        three = None if context is None or self.order < 3 else self.trigrams(context, ids)
        return self._log10(words, at[:len(ids)], at[len(ids):], self.bigram_table(pairs)[:, 0], pair_at,
                           self.bigram_counts(some), self.bigram_table(some), some_at, three)

    def log10_texts(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`log10` of the tokens of whole texts.  A text's bigrams are both the
        bigrams and, one token later, the contexts, so each distinct one is looked up once."""
        first = np.cumsum(sizes) - sizes
        words, own = distinct(np.append(ids, np.uint32(self.begin)))
        own, begin = own[:-1], own[-1]
        last = np.empty_like(own)
        last[1:] = own[:-1]
        last[first] = begin
        # an unknown word's id is in no stored bigram; sorted hashes have sorted ranks
        pairs, pair_at = distinct(pair_keys(words[last], words[own]))
        ranks = np.append(self.ranks(pairs), -1)
        table = np.zeros((len(ranks), 4), np.int64)
        count = np.zeros(len(ranks), np.int64)
        held = np.flatnonzero(ranks >= 0)
        table[held], count[held] = self.bigram_table(ranks[held]), self.bigram_counts(ranks[held])
        before = np.empty_like(pair_at)
        before[1:] = pair_at[:-1]
        before[first] = len(pairs)               # nothing before a text's first token
        three = self.trigrams(ranks[before], ids) if self.order > 2 else None
        return self._log10(words, own, last, table[:, 0], pair_at, count, table, before, three)

    def _log10(self, words, own, last, pair, pair_at, counts, table, context_at, three):
        """Probabilities of tokens from their ``words``, the continuation counts of their
        bigrams and the counts and statistics of the contexts, each looked up once, with
        the place of every token in them."""
        stats = self.stats(words)
        cont = stats[:, 1]
        p1 = np.maximum(cont - discount(cont, self.d1), 0) / max(1, self.continuations) + self.gamma / (self.vocabulary + 1)
        total = stats[:, 5]
        left = (stats[:, 2:5] * np.array(self.d2)).sum(1) / np.maximum(total, 1)
        left[total == 0] = 1.0
        p = np.maximum(pair - discount(pair, self.d2), 0)[pair_at] / np.maximum(total, 1)[last] + left[last] * p1[own]
        if three is not None:
            followers = table[:, 1:]
            left = (followers * np.array(self.d3)).sum(1) / np.maximum(counts, 1)
            left[followers.sum(1) == 0] = 1.0
            p = np.maximum(three - discount(three, self.d3), 0) / np.maximum(counts, 1)[context_at] + left[context_at] * p
        count = stats[:, 0]
        return np.log10(p), np.log10((count + 1) / (self.n + self.vocabulary + 1))[own], count[own]


def pair_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mix(before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64))


def previous(ranks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each token the rank of the bigram that ends before it; -1 for a text's first."""
    out = np.empty_like(ranks)
    out[1:] = ranks[:-1]
    out[np.cumsum(sizes) - sizes] = -1
    return out


def discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts from how many entries were seen 1, 2, 3 and 4 times;
    half the count where these counts give none."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(d if 0 < d <= k else k / 2)
    return tuple(out)


# ---------------------------------------------------------------- counting


def _chunks(batches: Iterator[pd.DataFrame], points: int = CHUNK_POINTS) -> Iterator[list[str]]:
    part, size = [], 0
    for b in batches:
        for t in b["text"]:
            part.append(t)
            size += len(t)
            if size >= points:
                yield part
                part, size = [], 0
    if part:
        yield part


def count_words(docs: DataFrame, ranges: int) -> DataFrame:
    """range, path of its sorted word hashes, path of their counts, and sums."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, n = [], 0, 0
        for texts in _chunks(batches):
            n += len(texts)
            held.append(np.unique(word_hash(split(texts)[0]), return_counts=True))
            size += len(held[-1][0])
            if size >= RUN_TOKENS // 2:
                yield out(held, n)
                held, size, n = [], 0, 0
        if held:
            yield out(held, n)

    def out(held: list, n: int) -> pd.DataFrame:
        runs = _runs(*add_up(*(np.concatenate(x) for x in zip(*held, strict=True))), ranges).assign(documents=0)
        return pd.concat([runs, pd.DataFrame([(0, None, n)], columns=["range", "run", "documents"])])

    return docs.mapInPandas(count, "range int, run binary, documents long")


def store_words(runs: DataFrame, folder: str) -> DataFrame:
    def store(key, rows: pd.DataFrame) -> pd.DataFrame:
        some = rows["run"].dropna()
        paths, words, total = ("", ""), 0, 0
        if len(some):
            keys, counts = merge_runs(some)
            paths = write_array(folder, f"words-{key[0]}", keys), write_array(folder, f"word-counts-{key[0]}", counts)
            words, total = len(keys), int(counts.sum())
        return pd.DataFrame([(key[0], *paths, words, total, int(rows["documents"].sum()))],
                            columns=["range", "keys", "counts", "words", "total", "documents"])
    return runs.groupBy("range").applyInPandas(store, "range int, keys string, counts string, words long, total long, documents long")


def count_bigrams(docs: DataFrame, shared, ranges: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, held, size = shared.value, [], 0
        for texts in _chunks(batches):
            ids, sizes = model.encode(texts)
            held.append(pair_keys(model.contexts(ids, sizes), ids))
            size += len(ids)
            if size >= RUN_TOKENS:
                yield _runs(*np.unique(np.concatenate(held), return_counts=True), ranges)
                held, size = [], 0
        if held:
            yield _runs(*np.unique(np.concatenate(held), return_counts=True), ranges)
    return docs.mapInPandas(count, "range int, run binary")


def store_bigrams(runs: DataFrame, folder: str) -> DataFrame:
    """A row per range with its files and how many bigrams it holds."""
    def store(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merge_runs(rows["run"])
        files = [write_array(folder, f"bigrams-{key[0]}", keys), *write_counts(folder, f"bigram-counts-{key[0]}", counts[None])]
        return pd.DataFrame([(key[0], *files, len(keys))], columns=["range", "keys", "small", "large", "size"])
    return runs.groupBy("range").applyInPandas(store, "range int, keys string, small string, large string, size long")


def count_trigrams(docs: DataFrame, shared, ranges: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, held, size = shared.value, [], 0
        for texts in _chunks(batches):
            held.append(model.encode(texts))
            size += len(held[-1][0])
            if size >= RUN_TOKENS // 2:
                yield out(model, held)
                held, size = [], 0
        if held:
            yield out(model, held)

    def out(model: Model, held: list) -> pd.DataFrame:
        ids, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
        pairs, at = distinct(pair_keys(model.contexts(ids, sizes), ids))
        context = previous(model.ranks(pairs)[at], sizes)
        keys = model.trigram_keys(context[context >= 0], ids[context >= 0])
        return _runs(*np.unique(keys, return_counts=True), ranges)

    return docs.mapInPandas(count, "range int, run binary")


def _by_range(marks: np.ndarray, times: np.ndarray, starts: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """Runs of marks by the range their id or rank is in."""
    own = np.searchsorted(starts, (marks >> np.uint64(bits)).astype(np.int64), side="right") - 1
    cuts = np.searchsorted(own, np.arange(len(starts) + 1))
    for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            yield r, pack_run(marks[a:b], times[a:b])


def store_trigrams(runs: DataFrame, shared, folder: str) -> DataFrame:
    """A row per range with its files and counts of counts (``bigram_range`` NULL), and
    runs of context and continuation statistics by range of bigram ranks."""
    def store(key, rows: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        keys, counts = merge_runs(rows["run"])
        files = [write_array(folder, f"trigrams-{key[0]}", keys), *write_counts(folder, f"trigram-counts-{key[0]}", counts[None])]
        out = [(None, key[0], *files, [int((counts == k).sum()) for k in (1, 2, 3, 4)], None)]
        grams = unmix(keys)
        del keys
        context, ids = grams >> np.uint64(model.word_bits), grams & np.uint64((1 << model.word_bits) - 1)
        later = model.ranks(pair_keys(model.second(context.astype(np.int64)), ids)).astype(np.uint64)
        # statistics as keys rank * 4 + kind: 0 continuations, 1..3 followers seen 1, 2, 3+ times
        marks = np.concatenate([later << np.uint64(2), context << np.uint64(2) | np.minimum(counts, 3).astype(np.uint64)])
        del grams, later, context, ids
        marks, times = np.unique(marks, return_counts=True)
        out += [(r, key[0], None, None, None, None, run) for r, run in _by_range(marks, times, model.bigram_starts[:-1], 2)]
        return pd.DataFrame(out, columns=["bigram_range", "range", "keys", "small", "large", "n", "run"]).astype({"bigram_range": "Int32"})
    return runs.groupBy("range").applyInPandas(
        store, "bigram_range int, range int, keys string, small string, large string, n array<long>, run binary")


def store_bigram_stats(runs: DataFrame, shared, folder: str) -> DataFrame:
    """Continuation counts (plain ones at the highest order and after the begin) and
    context statistics of every bigram.  A row per range (``word_range`` NULL), and runs
    of statistics by range of word ids."""
    def store(key, rows: pd.DataFrame) -> pd.DataFrame:
        model, r = shared.value, int(key[0])
        keys, small, large = (map_array(p) for p in model.bigram_files[r])
        pairs = unmix(keys[:])
        first, last = pairs >> np.uint64(32), pairs & np.uint64(UNKNOWN)
        table = np.zeros((4, len(pairs)), np.int64)
        if len(some := rows["run"].dropna()):
            marks, times = merge_runs(some)
            table[(marks & np.uint64(3)).astype(np.int64), (marks >> np.uint64(2)).astype(np.int64) - model.bigram_starts[r]] = times
        plain = np.flatnonzero(first == model.begin) if model.order > 2 else np.arange(len(pairs))
        table[0, plain] = read_counts(small, large, plain)[:, 0]
        files, counts = write_counts(folder, f"bigram-stats-{r}", table), table[0]
        out = [(None, r, *files, [int((counts == k).sum()) for k in (1, 2, 3, 4)], None)]
        # statistics as keys id * 8 + kind: 0 continuations, 1..3 followers seen 1, 2, 3+ times, 4 their sum
        marks, times = np.unique(np.concatenate([last << np.uint64(3), first << np.uint64(3) | np.minimum(counts, 3).astype(np.uint64)]),
                                 return_counts=True)
        heads, at = distinct(first)
        sums = np.zeros(len(heads), np.int64)
        np.add.at(sums, at, counts)
        marks, times = np.concatenate([marks, heads << np.uint64(3) | np.uint64(4)]), np.concatenate([times, sums])
        order = np.argsort(marks)
        out += [(w, r, None, None, None, run) for w, run in _by_range(marks[order], times[order], model.word_starts, 3)]
        return pd.DataFrame(out, columns=["word_range", "range", "small", "large", "n", "run"]).astype({"word_range": "Int32"})
    return runs.groupBy("range").applyInPandas(
        store, "word_range int, range int, small string, large string, n array<long>, run binary")


def store_stats(runs: DataFrame, shared, folder: str) -> DataFrame:
    def store(key, rows: pd.DataFrame) -> pd.DataFrame:
        model, r = shared.value, int(key[0])
        special = r == len(model.word_files)
        start = int(model.word_starts[r])
        size = 2 if special else int(model.word_starts[r + 1]) - start
        table = np.zeros((size, 6), np.int64)
        if special:      # the end, and the begin (a context as often as there are documents)
            table[:, 0] = model.documents
        else:
            table[:, 0] = map_array(model.word_files[r][1])
        marks, times = merge_runs(rows["run"])
        ids, kind = (marks >> np.uint64(3)).astype(np.int64) - start, (marks & np.uint64(7)).astype(np.int64)
        table[ids, kind + 1] = times
        cont = table[:, 1]
        return pd.DataFrame([(r, write_array(folder, f"stats-{r}", table), [int((cont == k).sum()) for k in (1, 2, 3, 4)],
                              int((cont > 0).sum()), int(cont.sum()))], columns=["range", "path", "m", "types", "total"])
    return runs.groupBy("word_range").applyInPandas(store, "range int, path string, m array<long>, types long, total long")


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Count ``text`` of ``docs`` and store the model in the shared folder."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    folder = materialize_folder(spark)
    docs = docs.select(text_of().alias("text"))
    model = Model()
    model.order = order
    ranges = _power(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = materialize(store_words(count_words(docs, ranges), folder), "lm-words").collect()
    model.word_files = [None] * ranges
    sizes = np.zeros(ranges, np.int64)
    for r in rows:
        if r["words"]:
            model.word_files[r["range"]] = (r["keys"], r["counts"])
        sizes[r["range"]] = r["words"]
        model.n += r["total"] + r["documents"]
        model.documents += r["documents"]
    # the last range, of two ids, holds the end and the begin
    model.word_starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    words = int(sizes.sum())
    if words + 2 >= UNKNOWN:
        raise ValueError("word ids are 32-bit numbers")
    model.vocabulary = words + (1 if model.documents else 0)
    if not model.documents:
        return model
    shared = spark.sparkContext.broadcast(model)
    grams = _power(max(ranges, model.n / RANGE_TOKENS))
    bigrams = materialize(store_bigrams(count_bigrams(docs, shared, grams), folder), "lm-bigrams")
    model.bigram_files, sizes = [None] * grams, np.zeros(grams, np.int64)
    for r in bigrams.collect():
        model.bigram_files[r["range"]] = (r["keys"], r["small"], r["large"])
        sizes[r["range"]] = r["size"]
    model.bigram_starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    shared = spark.sparkContext.broadcast(model)
    visits = bigrams.select("range", F.lit(None).cast("binary").alias("run"))
    if order > 2:
        if int(sizes.sum()).bit_length() + model.word_bits > 64:
            raise ValueError("a trigram's context and word have to fit 64 bits")
        wide = _power(max(ranges, 2 * model.n / RANGE_TOKENS))
        trigrams = materialize(store_trigrams(count_trigrams(docs, shared, wide), shared, folder), "lm-trigrams")
        model.trigram_files, n = [None] * wide, [0] * 4
        for r in trigrams.where("bigram_range IS NULL").drop("run").collect():
            model.trigram_files[r["range"]] = (r["keys"], r["small"], r["large"])
            n = [a + b for a, b in zip(n, r["n"], strict=True)]
        model.d3 = discounts(n)
        visits = visits.unionByName(trigrams.where("bigram_range IS NOT NULL").select(F.col("bigram_range").alias("range"), "run"))
    table = materialize(store_bigram_stats(visits, shared, folder), "lm-bigram-stats")
    model.bigram_stats, n = [None] * grams, [0] * 4
    for r in table.where("word_range IS NULL").drop("run").collect():
        model.bigram_stats[r["range"]] = (r["small"], r["large"])
        n = [a + b for a, b in zip(n, r["n"], strict=True)]
    model.d2 = discounts(n)
    rows = materialize(store_stats(table.where("word_range IS NOT NULL"), shared, folder), "lm-stats").collect()
    model.stat_files, m, types = [None] * (ranges + 1), [0] * 4, 0
    for r in rows:
        model.stat_files[r["range"]] = r["path"]
        m = [a + b for a, b in zip(m, r["m"], strict=True)]
        types += r["types"]
        model.continuations += r["total"]
    model.d1 = discounts(m)
    d = model.d1
    model.gamma = (d[0] * m[0] + d[1] * m[1] + d[2] * (types - m[0] - m[1])) / model.continuations
    return model


def materialize_folder(spark) -> str:
    import uuid
    return f"{scratch_root(spark)}/lm-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- scoring


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """doc_id and the carried columns with n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*carry).schema)
    own = ["doc_id", *carry]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            cuts = np.flatnonzero(np.diff(np.cumsum(b["text"].str.len().to_numpy()) // CHUNK_POINTS)) + 1
            for part in np.split(np.arange(len(b)), cuts):
                rows = b.iloc[part]
                if not len(rows):
                    continue
                ids, sizes = m.encode(rows["text"].tolist())
                logs, base, counts = m.log10_texts(ids, sizes)
                first = np.cumsum(sizes) - sizes
                yield rows[own].assign(n_tokens=sizes, n_known=np.add.reduceat((counts > 0).astype(np.int64), first),
                                         train_tokens=m.n, base_score=np.add.reduceat(base, first),
                                         score=np.add.reduceat(logs, first))

    return map_documents(docs.select(*own, text_of().alias("text")), run,
                         f"{kinds}n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 7) == 2


def lm_scores(df: DataFrame, order: int = ORDER) -> DataFrame:
    """Every document scored by a model of those that are not held out; with the
    perplexity of a token."""
    docs = df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    model = train(docs.where(~F.col("held_out")), order)
    return score(docs, model, ["held_out"]).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
