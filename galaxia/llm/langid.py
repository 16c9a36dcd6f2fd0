"""Language identification of mixed text.

Learning counts, over all labelled training documents, hashed byte n-grams of
words and the scripts of their letters by language; one aggregation in Spark.

Prediction is word by word: the script ranges of a word's letters leave the
languages that use this script; each of them gets the word's n-gram log
likelihood; a Viterbi pass over the words, with a penalty for changing the
language, labels spans.  The document's language is the one with most letters in
its spans, and the score its share of all letters.

A word's scores are computed once per worker; Viterbi runs over many documents
of like length at once.

Defined results: `und` with score 0 where the text is NULL or holds no letter,
or nothing was learned; words without a letter say nothing and stay in the span
around them; equal shares go to the language first in order; repeated rows get
the same result; an empty table gives an empty result; other columns, the labels
of a document that is predicted among them, are never read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, map_documents, text_of

FEATURES = 1 << 16
SIZES = (2, 3, 4)
SWITCH_PENALTY = 8.0
SMOOTHING = 0.5
#: A language uses a script if so large a share of its letters is of it.
SCRIPT_SHARE = 0.01
CACHE_WORDS = 1 << 20
#: Words of the documents that one Viterbi pass takes together, padding included.
PASS_WORDS = 1 << 19

# First code point of blocks of letters and their script (Unicode).
SCRIPTS = [(0x0041, "Latin"), (0x0250, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
           (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0780, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"),
           (0x0A00, "other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "other"), (0x0E00, "Thai"),
           (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"),
           (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"),
           (0x3040, "Kana"), (0x3100, "other"), (0x31F0, "Kana"), (0x3400, "Han"), (0xA000, "other"),
           (0xA640, "Cyrillic"), (0xA6A0, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"),
           (0xFB00, "Latin"), (0xFB13, "other"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFF21, "Latin"),
           (0xFF66, "Kana"), (0xFFA0, "other"), (0x20000, "Han"), (0x32000, "other")]
_STARTS = [s for s, _ in SCRIPTS]
NAMES = sorted({n for _, n in SCRIPTS})
_NUMBER = {n: i for i, n in enumerate(NAMES)}
_TRIM = b".,;:!?\"'()[]{}*&$%#|<>"


def script(letter: str) -> int:
    return _NUMBER[SCRIPTS[max(0, bisect_right(_STARTS, ord(letter)) - 1)][1]]


def letters(word: bytes) -> tuple[int, int]:
    """How many letters a word has, and the script of most of them (-1: none)."""
    if word.isalpha():          # ASCII letters only
        return len(word), _NUMBER["Latin"]
    own = [c for c in word.decode("utf-8", "replace") if c.isalpha()]
    if not own:
        return 0, -1
    count = Counter(map(script, own))
    return len(own), min(count, key=lambda s: (-count[s], s))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, and where each word's begin; a word always has some."""
    marked = [b"^" + (w.strip(_TRIM) or w) + b"$" for w in words]
    data = np.frombuffer(b"".join(marked) + b"\0" * max(SIZES), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(marked)), sizes)
    place = np.arange(len(owner)) - starts[owner]
    found, owners = [], []
    for n in SIZES:
        at = np.flatnonzero(place <= sizes[owner] - n)
        h = np.full(len(at), n, np.uint32)
        for k in range(n):
            h = (h ^ data[at + k]) * np.uint32(16777619) + np.uint32(n)
        found.append((h ^ (h >> np.uint32(15))) % np.uint32(FEATURES))
        owners.append(owner[at])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order].astype(np.int64), np.searchsorted(owners[order], np.arange(len(words)))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0


# ---------------------------------------------------------------- learning


def feature_counts(train: DataFrame) -> DataFrame:
    """lang, feature, n over all training documents; features from FEATURES on are scripts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, seen.values())) > CACHE_WORDS:
                yield from out(seen)
                seen = {}
        yield from out(seen)

    def out(seen: dict[str, Counter]) -> Iterator[pd.DataFrame]:
        for lang, counter in seen.items():
            pairs = [(w, n, *letters(w)) for w, n in counter.items()]
            pairs = [p for p in pairs if p[2]]
            total = np.zeros(FEATURES + len(NAMES), np.int64)
            for i in range(0, len(pairs), 100_000):
                part = pairs[i:i + 100_000]
                f, at = features([p[0] for p in part])
                times = np.array([p[1] for p in part])
                total += np.bincount(f, np.repeat(times, np.diff(np.append(at, len(f)))), len(total)).astype(np.int64)
                total += np.bincount([FEATURES + p[3] for p in part], times * [p[2] for p in part], len(total)).astype(np.int64)
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "feature": used, "n": total[used]})

    return (train.select("lang", text_of().alias("text")).mapInPandas(count, "lang string, feature int, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")))


class Model:
    """Log likelihoods by feature and language, and who uses which script."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        table = np.zeros((FEATURES + len(NAMES), len(self.langs)))
        table[counts["feature"], np.searchsorted(self.langs, counts["lang"])] = counts["n"]
        grams, scripts = table[:FEATURES] + SMOOTHING, table[FEATURES:]
        self.logs = np.log(grams / grams.sum(0)).astype(np.float32)
        uses = scripts / np.maximum(scripts.sum(0), 1) >= SCRIPT_SHARE
        uses[~uses.any(1)] = True                       # a script nobody uses rules nobody out
        self.barred = np.where(uses, 0, -1e4).astype(np.float32)
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.scores = np.zeros((1024, len(self.langs)), np.float32)
        self.letters = np.zeros(1024, np.int64)

    def learn(self, words: set[bytes]) -> None:
        """Score new words and remember them."""
        new = list(words)
        for i in range(0, len(new), 100_000):
            part = new[i:i + 100_000]
            at = len(self.index)
            while at + len(part) > len(self.letters):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
            f, starts = features(part)
            own = [letters(w) for w in part]
            n, which = np.array([x[0] for x in own]), np.array([x[1] for x in own])
            score = np.add.reduceat(self.logs[f], starts) / len(SIZES) + self.barred[np.maximum(which, 0)]
            score = score - score.max(1, keepdims=True)
            self.scores[at:at + len(part)] = np.where(n[:, None] > 0, score, 0)
            self.letters[at:at + len(part)] = n
            self.index.update(zip(part, range(at, at + len(part)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [words_of(t) for t in texts]
        missing = set().union(*(set(w).difference(self.index) for w in split))
        if len(self.index) + len(missing) > CACHE_WORDS:
            self.forget()
            missing = set().union(*map(set, split))
        if missing:
            self.learn(missing)
        return [np.fromiter(map(self.index.__getitem__, w), np.int64, len(w)) for w in split]


def viterbi(scores: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each word: scores (documents, words, languages) -> (documents, words).
    Staying wins over changing at equal scores."""
    docs, steps, langs = scores.shape
    back = np.empty((steps, docs, langs), np.uint8 if langs <= 256 else np.uint32)
    rows, own = np.arange(docs), np.arange(langs)
    value = scores[:, 0].copy()
    for t in range(1, steps):
        top = value.argmax(1)
        change = value[rows, top] - penalty
        stay = value >= change[:, None]
        back[t] = np.where(stay, own, top[:, None])
        value = np.maximum(value, change[:, None]) + scores[:, t]
    label = np.empty((steps, docs), np.int64)
    label[-1] = value.argmax(1)
    for t in range(steps - 1, 0, -1):
        label[t - 1] = back[t, rows, label[t]]
    return label.T


def label_documents(model: Model, texts: list[str], penalty: float = SWITCH_PENALTY) -> list[tuple]:
    """For every text the labels and the numbers of its words."""
    coded = model.encode(texts)
    out: list = [np.zeros(0, np.int64)] * len(texts)
    order = sorted((i for i, c in enumerate(coded) if len(c)), key=lambda i: len(coded[i]))
    while order:
        longest, take = len(coded[order[-1]]), []
        while order and (not take or (len(take) + 1) * longest <= PASS_WORDS and 2 * len(coded[order[-1]]) >= longest):
            take.append(order.pop())
        scores = np.zeros((len(take), longest, len(model.langs)), np.float32)
        for k, i in enumerate(take):
            scores[k, :len(coded[i])] = model.scores[coded[i]]
        for k, label in zip(take, viterbi(scores, penalty), strict=True):
            out[k] = label[:len(coded[k])]
    return [(label, coded[i]) for i, label in enumerate(out)]


def train(docs: DataFrame) -> Model:
    """A model of the documents that have a label and are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    return Model(feature_counts(labelled).toPandas())


def identify(df: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, lang_pred, score and spans (first word, words, lang) of every text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            size = np.cumsum(b["text"].str.len().to_numpy()) // 4_000_000
            for part in np.split(np.arange(len(b)), np.flatnonzero(np.diff(size)) + 1):
                if len(part):
                    yield predict(m, b.iloc[part])

    def predict(m: Model, rows: pd.DataFrame) -> pd.DataFrame:
        names, out = m.langs, []
        found = label_documents(m, rows["text"].tolist(), penalty) if names else [(None, None)] * len(rows)
        for doc_id, (label, coded) in zip(rows["doc_id"], found, strict=True):
            weight = m.letters[coded] if names else np.zeros(0)
            total = weight.sum()
            if not total:
                out.append((doc_id, "und", 0.0, []))
                continue
            share = np.bincount(label, weight, len(names))
            first = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
            spans = [{"first_word": int(a), "words": int(b - a), "lang": names[label[a]]}
                     for a, b in zip(first, np.append(first[1:], len(label)), strict=True)]
            out.append((doc_id, names[int(share.argmax())], float(share.max() / total), spans))
        return pd.DataFrame(out, columns=["doc_id", "lang_pred", "score", "spans"])

    return map_documents(df.select("doc_id", text_of().alias("text")), run,
                         "lang_pred string, score double, spans array<struct<first_word:int,words:int,lang:string>>")
