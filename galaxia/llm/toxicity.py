"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs of a word: an embedding of the word, the mean embedding of its character
trigrams, and its log odds among the training documents.  Two gated recurrent
layers read a window forward and backward, attention pools their states, and a
linear layer gives the window's logit.  Windows of ``WINDOW`` words overlap by
``WINDOW - STRIDE`` and cover the whole text, so any passage of half a window lies in
one whole; the text's logit is its highest
window's.

Training (numpy, on the driver) uses a bounded sample of labelled documents:
``SAMPLE`` of either class at most, near copies dropped.  Of a document of more than
``SAMPLE_WORDS`` words the ``SAMPLE_WINDOWS`` windows of lowest hash stand for it, so
a class of long documents is learned too, and a copy gives the same windows.  A class
that has labels but no text to learn from is logged.  A document's label is its windows'
only in the highest one, so epochs pick that window anew for toxic documents and
any windows for clean ones.

Scoring runs in Spark tasks over every window of every document.  A word's input
projections are computed once per worker.

Defined results: NULL, empty or blank text scores 0; repeated rows get the same
score; with labels of one class only, or none, every text scores 0; an empty
table gives an empty result; labels are read for training only, and other columns
never.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, lowest_hashes, map_documents, text_of

WINDOW = 64
STRIDE = 32
SAMPLE = 1200
SAMPLE_WORDS = 1500
SAMPLE_WINDOWS = 48
HIDDEN = 8
ATTENTION = 8
WORD_ROWS, WORD_DIM = 4096, 4
CHAR_ROWS, CHAR_DIM = 2048, 6
EPOCHS = 6
#: Documents added to either class when a word's log odds are taken.
SMOOTHING = 5
CACHE_WORDS = 1 << 19
BATCH = 1024
_TRIM = b".,;:!?\"'()[]{}*&$%#|<>"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0


def windows(n: int) -> list[tuple[int, int]]:
    """Overlapping windows over n words; the last one ends at the last word."""
    if n == 0:
        return []
    return [(a, min(a + WINDOW, n)) for a in range(0, max(1, n - WINDOW + STRIDE), STRIDE)]


def describe(words: list[bytes], odds: dict[bytes, float]):
    """Rows of the word, rows of its character trigrams (flat, with starts), log odds."""
    from xxhash import xxh32_intdigest
    bare = [w.strip(_TRIM) or w for w in words]
    rows = np.fromiter((xxh32_intdigest(w) % WORD_ROWS for w in bare), np.int64, len(bare))
    marked = [b"^" + w + b"$" for w in bare]
    data = np.frombuffer(b"".join(marked) + b"\0\0", np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(marked)), sizes)
    at = np.flatnonzero(np.arange(len(owner)) - first[owner] <= sizes[owner] - 3)
    h = ((data[at] * np.uint32(961) + data[at + 1] * np.uint32(31) + data[at + 2]) * np.uint32(2654435761)) >> np.uint32(16)
    starts = np.searchsorted(owner[at], np.arange(len(marked)))
    return rows, (h % np.uint32(CHAR_ROWS)).astype(np.int64), starts, np.array([odds.get(w, 0.0) for w in bare], np.float32)


class Network:
    """Parameters, the forward pass and its gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        dim, h, a = WORD_DIM + CHAR_DIM + 1, HIDDEN, ATTENTION

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"word": normal(WORD_ROWS, WORD_DIM, scale=0.1), "char": normal(CHAR_ROWS, CHAR_DIM, scale=0.1),
                  "attend": normal(2 * h, a, scale=0.3), "attend_b": np.zeros(a, np.float32), "query": normal(a, scale=0.3),
                  "out": normal(2 * h, scale=0.3), "out_b": np.zeros(1, np.float32)}
        for d in "fb":     # gates in the order update, reset, candidate
            self.p |= {f"x{d}": normal(dim, 3 * h, scale=0.3), f"b{d}": np.zeros(3 * h, np.float32), f"u{d}": normal(h, 3 * h, scale=0.3)}
        self.odds: dict[bytes, float] = {}

    def inputs(self, described) -> np.ndarray:
        rows, chars, starts, odds = described
        n = np.diff(np.append(starts, len(chars)))[:, None]
        mean = np.add.reduceat(self.p["char"][chars], starts) / n
        return np.concatenate([self.p["word"][rows], mean.astype(np.float32), odds[:, None]], axis=1)

    def _layer(self, proj: np.ndarray, index: np.ndarray, mask: np.ndarray, d: str, keep: list | None):
        """States (steps, windows, HIDDEN) of one direction; proj holds a word's projected input."""
        steps, n = index.shape
        h, u = HIDDEN, self.p[f"u{d}"]
        out = np.empty((steps, n, h), np.float32)
        state = np.zeros((n, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x, s = proj[index[t]], state @ u
            gates = 0.5 * np.tanh(0.5 * (x[:, :2 * h] + s[:, :2 * h])) + 0.5
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(x[:, 2 * h:] + r * s[:, 2 * h:])
            new = c + z * (state - c)
            if mask is not None:
                new = np.where(mask[t][:, None], new, state)
            if keep is not None:
                keep.append((t, state, z, r, c, s[:, 2 * h:]))
            out[t] = state = new
        return out

    def _pool(self, states: np.ndarray, mask: np.ndarray | None):
        key = np.tanh(states @ self.p["attend"] + self.p["attend_b"])
        weight = key @ self.p["query"]
        if mask is not None:
            weight = np.where(mask, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        return key, weight, pooled, pooled @ self.p["out"] + self.p["out_b"][0]

    def project(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ self.p["xf"] + self.p["bf"], x @ self.p["xb"] + self.p["bb"]], axis=1)

    def logits(self, proj: np.ndarray, index: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """index, mask: (steps, windows); proj: a word's inputs of both directions."""
        g = 3 * HIDDEN
        states = np.concatenate([self._layer(proj[:, :g], index, mask, "f", None),
                                 self._layer(proj[:, g:], index, mask, "b", None)], axis=2)
        return self._pool(states, mask)[3]

    def gradients(self, described, index: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """Mean logistic loss of windows and its gradient for every parameter."""
        p, h, g = self.p, HIDDEN, 3 * HIDDEN
        x = self.inputs(described)
        proj, kept = self.project(x), {"f": [], "b": []}
        states = np.concatenate([self._layer(proj[:, :g], index, mask, "f", kept["f"]),
                                 self._layer(proj[:, g:], index, mask, "b", kept["b"])], axis=2)
        key, weight, pooled, logit = self._pool(states, mask)
        prob = 1 / (1 + np.exp(-logit))
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        dlogit = ((prob - y) / len(y)).astype(np.float32)
        grad["out"], grad["out_b"][0] = pooled.T @ dlogit, dlogit.sum()
        dpool = dlogit[:, None] * p["out"]
        dweight = np.einsum("nh,tnh->tn", dpool, states)
        dstates = weight[:, :, None] * dpool
        dscore = weight * (dweight - (weight * dweight).sum(0))
        grad["query"] = np.einsum("tn,tna->a", dscore, key)
        dkey = dscore[:, :, None] * p["query"] * (1 - key * key)
        grad["attend"], grad["attend_b"] = np.einsum("tnh,tna->ha", states, dkey), dkey.sum((0, 1))
        dstates = dstates + dkey @ p["attend"].T
        dproj = np.zeros_like(proj)
        for k, d in enumerate("fb"):
            u, part = p[f"u{d}"], dproj[:, k * g:(k + 1) * g]
            carry = np.zeros((index.shape[1], h), np.float32)
            for t, state, z, r, c, su in reversed(kept[d]):
                total = dstates[t][:, k * h:(k + 1) * h] + carry
                dnew = total * mask[t][:, None]
                dz = dnew * (state - c) * z * (1 - z)
                dc = dnew * (1 - z) * (1 - c * c)
                dr = dc * su * r * (1 - r)
                dgate = np.concatenate([dz, dr, dc], axis=1)
                inner = np.concatenate([dz, dr, dc * r], axis=1)
                grad[f"u{d}"] += state.T @ inner
                carry = total * ~mask[t][:, None] + dnew * z + inner @ u.T
                np.add.at(part, index[t], dgate)
            grad[f"x{d}"], grad[f"b{d}"] = x.T @ part, part.sum(0)
        dx = dproj[:, :g] @ p["xf"].T + dproj[:, g:] @ p["xb"].T
        rows, chars, starts, _ = described
        n = np.diff(np.append(starts, len(chars)))
        np.add.at(grad["word"], rows, dx[:, :WORD_DIM])
        np.add.at(grad["char"], chars, np.repeat(dx[:, WORD_DIM:WORD_DIM + CHAR_DIM] / n[:, None], n, axis=0))
        return loss, grad


def _grid(spans: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
    """Word numbers of windows as (steps, windows), and which are there (None: all)."""
    sizes = np.fromiter(map(len, spans), np.int64, len(spans))
    steps = int(sizes.max())
    index = np.zeros((len(spans), steps), np.int64)
    mask = np.arange(steps) < sizes[:, None]
    index[mask] = np.concatenate(spans)
    return np.ascontiguousarray(index.T), None if mask.all() else np.ascontiguousarray(mask.T)


def _distinct_documents(texts: list[list[bytes]]) -> list[int]:
    """Documents none of whose four min-hashes of five-word shingles was seen before."""
    from xxhash import xxh64_intdigest
    seen: set = set()
    out = []
    for i, words in enumerate(texts):
        h = np.array([xxh64_intdigest(b" ".join(words[k:k + 5])) for k in range(max(1, len(words) - 4))], np.uint64)
        keys = {(s, int(((h ^ np.uint64(s)) * np.uint64(0x9E3779B97F4A7C15 + 2 * s)).min())) for s in range(1, 5)}
        if not keys & seen:
            out.append(i)
        seen |= keys
    return out


def word_odds(texts: list[list[bytes]], y: np.ndarray) -> dict[bytes, float]:
    """Log odds of a word among toxic and clean documents, for words of three at
    least.  A document counts for a word only where it stands between neighbours
    not seen before, so a passage that many documents share counts once."""
    count, seen = [Counter(), Counter()], set()
    for words, label in zip(texts, y, strict=True):
        bare, own = [w.strip(_TRIM) or w for w in words], set()
        for around in zip([b"", *bare], bare, [*bare[1:], b""], strict=False):
            if (key := hash(around)) not in seen:
                seen.add(key)
                own.add(around[1])
        count[int(label)].update(own)
    n = [int((y == 0).sum()), int((y == 1).sum())]
    both = count[0] + count[1]
    out = {}
    for w, k in both.items():
        if k >= 3:
            rate = [(count[c][w] + SMOOTHING) / (n[c] + 2 * SMOOTHING) for c in (0, 1)]
            out[w] = float(np.clip(np.log(rate[1] / rate[0]), -3, 3))
    return out


def fit(texts: list[str | list[str]], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """A network of the texts, or None where one of the classes is missing.  A text may
    be given as a list of its windows."""
    parts = [[words_of(x) for x in ([t] if isinstance(t, str) else t)] for t in texts]
    coded = [[w for part in own for w in part] for own in parts]
    keep = [i for i in _distinct_documents(coded) if coded[i]]
    parts, coded, y = [parts[i] for i in keep], [coded[i] for i in keep], np.array([labels[i] for i in keep], np.float32)
    if len(set(y.tolist())) < 2:
        if len(set(labels)) > 1:
            logging.getLogger(__name__).warning("no distinct text with words is left of one labelled class: every text will score 0")
        return None
    net, rng = Network(seed), np.random.default_rng(seed)
    net.odds = word_odds(coded, y)
    vocabulary = sorted(set().union(*map(set, coded)))
    number = {w: i for i, w in enumerate(vocabulary)}
    rows, chars, starts, odds = describe(vocabulary, net.odds)
    ends = np.append(starts[1:], len(chars))
    spans, owner = [], []
    for i, pieces in enumerate(parts):
        for words in pieces:
            own = np.array([number[w] for w in words], np.int64)
            for a, b in windows(len(own)):
                spans.append(own[a:b])
                owner.append(i)
    owner = np.array(owner)
    first = np.searchsorted(owner, np.arange(len(coded)))
    best = np.array([odds[s].max() for s in spans])       # to begin with, the window with the most telling word
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, clean = 0, np.flatnonzero(y[owner] == 0)
    for epoch in range(epochs):
        if epoch:
            best = _window_logits(net, net.project(net.inputs((rows, chars, starts, odds))), spans)
        top = np.array([a + int(best[a:b].argmax()) for a, b in zip(first, np.append(first[1:], len(spans)), strict=True)])
        chosen = np.concatenate([top, rng.choice(clean, min(len(clean), len(top)), replace=False)])
        chosen = rng.permutation(chosen)
        for k in range(0, len(chosen), 64):
            part = chosen[k:k + 64]
            index, mask = _grid([spans[i] for i in part])
            used, index = np.unique(index, return_inverse=True)
            index = index.reshape(-1, len(part))
            mask = np.ones(index.shape, bool) if mask is None else mask
            flat = np.concatenate([chars[starts[u]:ends[u]] for u in used])
            sizes = ends[used] - starts[used]
            _, grad = net.gradients((rows[used], flat, np.cumsum(sizes) - sizes, odds[used]), index, mask, y[owner[part]])
            step += 1
            norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
            for name, v in grad.items():                    # Adam, clipped
                v = v * min(1.0, 1.0 / max(norm, 1e-9))
                m, s = moment[name]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                net.p[name] -= (0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def _window_logits(net: Network, proj: np.ndarray, spans: list[np.ndarray]) -> np.ndarray:
    """Logits of windows; those of one length run together, so whole windows need no mask."""
    out = np.empty(len(spans), np.float32)
    order = sorted(range(len(spans)), key=lambda i: len(spans[i]))
    sizes = [len(spans[i]) for i in order]
    full = int(np.searchsorted(sizes, WINDOW))
    for lo, hi in ((0, full), (full, len(order))):
        for k in range(lo, hi, BATCH):
            part = order[k:min(k + BATCH, hi)]
            out[part] = net.logits(proj, *_grid([spans[i] for i in part]))
    return out


class Scorer:
    """A network and the projected inputs of the words this worker has met."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.proj = np.zeros((4096, 6 * HIDDEN), np.float32)

    def learn(self, words: set[bytes]) -> None:
        new = list(words)
        for i in range(0, len(new), 50_000):
            part = new[i:i + 50_000]
            at = len(self.index)
            while at + len(part) > len(self.proj):
                self.proj = np.concatenate([self.proj, np.zeros_like(self.proj)])
            self.proj[at:at + len(part)] = self.net.project(self.net.inputs(describe(part, self.net.odds)))
            self.index.update(zip(part, range(at, at + len(part)), strict=True))

    def score(self, texts: list[str]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        missing = set().union(*(set(w).difference(self.index) for w in split))
        if len(self.index) + len(missing) > CACHE_WORDS:
            self.forget()
            missing = set().union(*map(set, split))
        if missing:
            self.learn(missing)
        spans, first = [], []
        for words in split:
            first.append(len(spans))
            own = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            spans.extend(own[a:b] for a, b in windows(len(own)))
        out = np.zeros(len(texts))
        some = [i for i, w in enumerate(split) if w]
        if some:
            logit = _window_logits(self.net, self.proj, spans)
            out[some] = 1 / (1 + np.exp(-np.maximum.reduceat(logit, [first[i] for i in some]).astype(float)))
        return out


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> list[tuple[str | list[str], int]]:
    """(text, label) of at most ``size`` documents of either class, by the hash of
    their ids, held-out ones left aside; long texts as a list of windows.  Rows that
    repeat an id count once; of different texts of an id the one of least hash counts."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("doc_id"))))
    order = F.xxhash64("doc_id", F.lit("sample"))
    ids = []
    for r in known.groupBy("toxic").count().where("toxic IN (0, 1)").orderBy("toxic").collect():
        own = known.where((F.col("toxic") == r["toxic"]) & lowest_hashes(order, r["count"], size))
        ids += sorted(own.collect())[:size]
    if not ids:
        return []
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in ids], "id long, toxic int"))
    rows = docs.select("doc_id", text_of().alias("text")).join(chosen, F.col("doc_id") == F.col("id"))
    # a row an id, however often it is repeated and whatever texts it has
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    rows = rows.select("doc_id", "text", "toxic", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("words"))
    long = F.size("words") > SAMPLE_WORDS
    rows = rows.select("doc_id", F.when(~long, F.col("text")).alias("text"), "toxic", F.when(long, _some_windows("words")).alias("windows"))
    found = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["text"] or "", r["windows"] or [], r["toxic"]))
    for label in sorted({r["toxic"] for r in ids} - {r["toxic"] for r in found}):
        logging.getLogger(__name__).warning("no document of the sampled ids labelled %d is there: every text will score 0", label)
    return [(r["windows"] if r["text"] is None else r["text"], r["toxic"]) for r in found]


def _some_windows(words: str) -> Column:
    """The ``SAMPLE_WINDOWS`` windows of lowest hash, of ``windows`` over the words."""
    starts = F.sequence(F.lit(0), F.size(words) - 1 - WINDOW + STRIDE, F.lit(STRIDE))
    every = F.transform(starts, lambda a: F.array_join(F.slice(words, a + 1, F.lit(WINDOW)), " "))
    hashed = F.transform(every, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))
    return F.transform(F.slice(F.array_sort(F.array_distinct(hashed)), 1, SAMPLE_WINDOWS), lambda x: x["w"])


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Network | None:
    rows = sample(docs, labels, size)
    return fit([t for t, _ in rows], [y for _, y in rows]) if rows else None


def score(df: DataFrame, net: Network | None) -> DataFrame:
    """doc_id and score of every text."""
    shared = df.sparkSession.sparkContext.broadcast(net)
    held: dict = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if shared.value is not None and "scorer" not in held:
            held["scorer"] = Scorer(shared.value)
        for b in batches:
            size = np.cumsum(b["text"].str.len().to_numpy()) // 2_000_000
            for part in np.split(np.arange(len(b)), np.flatnonzero(np.diff(size)) + 1):
                if len(part):
                    texts = b["text"].iloc[part].tolist()
                    found = held["scorer"].score(texts) if held else np.zeros(len(part))
                    yield pd.DataFrame({"doc_id": b["doc_id"].iloc[part].to_numpy(), "score": found})

    return map_documents(df.select("doc_id", text_of().alias("text")), run, "score double")
