"""Spelling variant grouping by blocked Gram matrices.

One edit changes the vector of a word's letter counts by a squared distance of 1
(a letter more or less) or 2 (one letter for another) and its length by at most
one.  Words are therefore put into blocks, and NumPy products of blocks of
letter-count vectors give all squared distances of two blocks at once; pairs at
most 2 apart are verified as real edits.

A length block is divided by how many letters of each of ``CLASSES`` letter
classes a word has.  An edit moves one letter into, out of, or between classes,
so only blocks of equal, adjacent or exchanged class counts are multiplied
rather than whole lengths; every near pair is in such a pair of blocks.  A class
with many words is dealt to blocks of about ``BLOCK_BYTES`` by a hash, so no
task holds more than two such blocks at a time, however common a word shape is;
the join that brings two blocks together is one that AQE splits.

Words are counted per document first, so a word that a third of the corpus
consists of is one row per task when it is shuffled.

Defined results: NULL and empty texts have no words; a NULL id is written as
nothing before the colon; rows repeated are counted each; a word without near
words has no form and is its own root; ties between forms go to the smaller word
in code-point order; very long words are blocks of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import slices, text_of

MIN_POINTS = 5
MIN_COUNT = 3
#: Every so many occurrences lose a letter, by the hash of document and word.
DELETE_EVERY = 97
CLASSES = 4
#: Characters of the words of one block, about.
BLOCK_BYTES = 16 << 10
#: Distinct words a task holds before it hands its counts on.
HELD = 300_000
#: Letters a-z and U+00C0 to U+00FF; all are one byte in Latin-1.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]


def _plan_bytes() -> bytes:
    """Latin-1 to Latin-1: A-Z lower-cased, letters kept, all else a blank."""
    table = bytearray(b" " * 256)
    for x in LETTERS:
        table[x] = x
    for x in range(0x41, 0x5B):
        table[x] = x + 32
    return bytes(table)


_PLAN = _plan_bytes()


def count_document(held: Counter, doc_id: str | None, text: str, every: int = DELETE_EVERY) -> None:
    """Add one document's words, in Latin-1, to the counts; some lose a letter first."""
    head = zlib.crc32(f"{doc_id or ''}:".encode())
    runs = text.encode("latin-1", "replace").translate(_PLAN).split()    # all other characters end a run
    held.update(runs)
    for run in set(runs):
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
        if not h % every:
            n, at = runs.count(run), h % len(run)
            held[run] -= n
            held[run[:at] + run[at + 1:]] += n


def corpus_words(df: DataFrame, every: int = DELETE_EVERY, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n over all whole texts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out():
            long = [(w.decode("latin-1"), n) for w, n in held.items() if len(w) >= min_points and n]
            held.clear()
            return pd.DataFrame(long, columns=["word", "n"])
        for b in slices(batches, "text"):
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                count_document(held, None if pd.isna(doc_id) else doc_id, text, every)
            if len(held) > HELD:
                yield out()
        yield out()

    rows = df.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).mapInPandas(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ blocks

def _shape(word):
    """How many letters of each class a word has; their sum is its length."""
    counts = []
    for c in range(CLASSES):
        others = "".join(map(chr, (x for x in LETTERS if x % CLASSES != c)))
        counts.append(F.char_length(F.translate(word, others, "")))
    return F.array(*counts)


def _moves() -> list[list[int]]:
    """Differences of two shapes an edit can lead to, each unordered pair once: none,
    one letter more in a class, one letter from a class to an earlier one."""
    unit = np.eye(CLASSES, dtype=int)
    return ([[0] * CLASSES] + [unit[i].tolist() for i in range(CLASSES)]
            + [(unit[i] - unit[j]).tolist() for i in range(CLASSES) for j in range(i + 1, CLASSES)])


def blocks(words: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """shape, salt, words (joined by blanks, in code-point order) and their counts."""
    shaped = words.select("word", "n", _shape(F.col("word")).alias("shape"))
    sizes = shaped.groupBy("shape").agg(F.ceil(F.sum(F.char_length("word")) / F.lit(block_bytes)).alias("salts"))
    dealt = shaped.join(sizes, "shape").withColumn("salt", F.pmod(F.xxhash64("word"), F.col("salts")))
    held = dealt.groupBy("shape", "salt").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"))
    return held.select("shape", "salt", F.array_join("w.word", " ").alias("words"), F.col("w.n").alias("counts"))


class _Block:
    def __init__(self, words: str, counts):
        self.words = np.array(words.split(" "), dtype=object)
        self.n = np.asarray(counts, dtype="int64")
        self.points = np.frombuffer("".join(self.words).encode("latin-1"), dtype="u1").reshape(len(self.words), -1)
        column = np.zeros(256, dtype="int64")
        column[LETTERS] = np.arange(len(LETTERS))
        cells = np.arange(len(self.words))[:, None] * len(LETTERS) + column[self.points]
        # whole numbers below 2^24 are exact in single precision
        kind = "float32" if self.points.shape[1] < 2000 else "float64"
        letters = np.bincount(cells.ravel(), minlength=len(self.words) * len(LETTERS)).reshape(-1, len(LETTERS)).astype(kind)
        square = (letters ** 2).sum(axis=1, keepdims=True)
        one = np.ones_like(square)
        # rows of left times rows of right: 2 less the squared distance
        self.left, self.right = np.hstack([2 * letters, -square, one]), np.hstack([letters, one, 2 - square])


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of code points that are one edit apart; those of b have as many or one more."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :size], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= size


def near_in(a: _Block, b: _Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (index in a, index in b) of two blocks; of one block, each once."""
    i, j = np.divmod(np.flatnonzero(a.left @ b.right.T >= 0), len(b.words))
    if same:
        i, j = i[i < j], j[i < j]
    step = max(1, (1 << 22) // b.points.shape[1])
    keep = [_one_edit(a.points[i[k:k + step]], b.points[j[k:k + step]]) for k in range(0, len(i), step)]
    keep = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
    return i[keep], j[keep]


def _best(own: _Block, other: _Block, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    """Per word of ``own`` with near words: how many, and the best of them."""
    order = np.lexsort((j, -other.n[j], i))     # a block's words are in code-point order
    i, j = i[order], j[order]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    return pd.DataFrame({"word": own.words[i[first]], "near": np.diff(np.append(first, len(i))),
                         "best_n": other.n[j[first]], "best": other.words[j[first]]})


def near_words(words: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """word, n_near, form and form_n (the near word of largest count) of each word
    that has near words."""
    held = materialize(blocks(words, block_bytes), "word-blocks")
    moves = F.array(*[F.array(*[F.lit(x) for x in m]) for m in _moves()])
    left = (held.select("*", F.explode(moves).alias("move"))
            .select(F.zip_with("shape", "move", lambda x, y: x + y).alias("shape"), (F.array_max("move") == 0).alias("own"),
                    F.col("salt").alias("a_salt"), F.col("words").alias("a_words"), F.col("counts").alias("a_counts"))
            .where(F.array_min("shape") >= 0))
    pairs = (left.join(held, "shape").where(~F.col("own") | (F.col("a_salt") <= F.col("salt")))
             .select((F.col("own") & (F.col("a_salt") == F.col("salt"))).alias("same"), "a_words", "a_counts", "words", "counts"))

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, _Block] = {}        # neighbouring rows share blocks

        def block(words, counts):
            if words not in known:
                if len(known) >= 64:
                    known.clear()
                known[words] = _Block(words, counts)
            return known[words]
        for batch in batches:
            out, rows = [], 0
            for r in batch.itertuples(index=False):
                a, b = block(r.a_words, r.a_counts), block(r.words, r.counts)
                i, j = near_in(a, b, r.same)
                if len(i):
                    out += [_best(a, b, i, j), _best(b, a, j, i)]
                    rows += len(out[-1]) + len(out[-2])
                if rows > 200_000:
                    yield pd.concat(out)
                    out, rows = [], 0
            if out:
                yield pd.concat(out)

    found = pairs.mapInPandas(multiply, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.word").alias("form"), (-F.col("b.n")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """From word, form: the last form of each word, by pointer doubling.  A form is at
    least twice as frequent as its word, so no chain is longer than 63 and six rounds do."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = materialize(now.join(further, "root", "left"), "word-roots")
        if jumped.where("next IS NOT NULL").isEmpty():
            return jumped.select("word", "root")
        now = jumped.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(words: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """From distinct words and their counts n: word, form, root, n, n_near, form_n."""
    words = materialize(words.select("word", "n"), "words")
    found = words.join(near_words(words, block_bytes), "word", "left")
    better = F.col("form_n") >= 2 * F.col("n")
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                     F.when(better, F.col("form")).alias("form"), F.when(better, F.col("form_n")).alias("form_n")), "word-forms")
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
