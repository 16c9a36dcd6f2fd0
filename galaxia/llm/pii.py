"""Personal data by a semi-Markov conditional random field over base patterns.

Base spans follow fixed patterns and always stay.  Around digits and `@` a text is
cut into tokens, and candidate segments (at most ``MAX_GROUPS`` runs of digits
with separators, address shapes; at most ``MAX_TOKENS`` tokens) are scored by features of the whole span:
how many digits, check digit, parts, separators, brackets, its neighbours.  A
dynamic program over segments chooses boundaries and kinds jointly, base spans
being fixed segments; the entities it finds besides are added.

Training (on the driver) maximises the conditional likelihood of the base spans in
a bounded sample of ``SAMPLE`` texts, half of them also with a span rewritten the
way people do (a phone number without its prefix, a card number with dots), so
that the model learns from whole spans rather than from one telling character.

Defined results: NULL or empty text has no spans; very long texts are read whole,
patterns and program are linear in them; repeated rows give the same spans; an
empty table gives an empty result; other columns are kept by ``redact`` and
ignored otherwise.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lowest_hashes, map_documents, text_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
MAX_TOKENS = 16
MAX_GROUPS = 6
MAX_DIGITS = 20
#: Characters of a text that training takes as one.
PIECE = 20_000
SAMPLE = 400
EPOCHS = 12

# The base patterns; possessive and look-behind forms keep them linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|[^\w\s]|_")
_DIGIT = re.compile(r"[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: its local part is the run before it."""
    end = 0          # of the last match, or past the last @: no local part holds one
    at = text.find("@")
    while at >= 0:
        run = _LOCAL.match(text[end:at][::-1]).end()
        end = at + 1
        if run and (m := _DOMAIN.match(text, at + 1)):
            yield at - run, m.end()
            end = m.end()
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by kind, then start."""
    if not _TRIGGER.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(q) <= 3 and int(q or "0") <= 255 for q in (p.lstrip("0") for p in m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m.group())) if m.end() - m.start() <= 64 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# ---------------------------------------------------------------- windows


def windows(text: str, spans: list[Span]) -> Iterator[tuple[list[tuple[int, int]], list[Span]]]:
    """Stretches of tokens around triggers, and the base spans inside each."""
    held, lo, hi = [], 0, -1
    for e in sorted({*(m.start() for m in _TRIGGER.finditer(text)), *(x for s in spans for x in s[1:])}):
        if e > hi:
            if hi >= 0:
                held.append((lo, hi))
            before = max(hi, 0)
            lo = max(before, e - 40)
            while lo > before and not text[lo - 1].isspace():    # no token is cut
                lo -= 1
        if e + 40 > hi:
            hi = min(len(text), e + 40)
            while hi < len(text) and not text[hi].isspace():
                hi += 1
    if hi >= 0:
        held.append((lo, hi))
    waiting, open_ = sorted(spans, key=lambda s: s[1], reverse=True), []
    for lo, hi in held:
        while waiting and waiting[-1][1] < hi:
            open_.append(waiting.pop())
        open_ = [s for s in open_ if s[2] > lo]
        yield [m.span() for m in _TOKEN.finditer(text, lo, hi)], list(open_)


def _numeric_kinds(s: str, digits: int) -> tuple[str, ...]:
    """What a run of so many digits may be at all."""
    out = ("ip",) if 4 <= digits <= 12 and s.count(".") == 3 and s.replace(".", "").isdigit() else ()
    return out + ("phone",) * ((8 if s[0] == "+" else 9) <= digits <= 15) + ("card",) * (13 <= digits <= 19)


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, tuple[str, ...]]]:
    """Segments (first token, past the last, kinds it may be)."""
    out, n = [], len(tokens)
    for i, (a, b) in enumerate(tokens):
        first = text[a]
        if first in "+(" or "0" <= first <= "9":
            digits = groups = 0
            for j in range(i, min(n, i + MAX_TOKENS)):
                c, d = tokens[j]
                if j > i and (c - tokens[j - 1][1] > 1 or (c > tokens[j - 1][1] and text[c - 1] != " ")):
                    break
                if "0" <= text[c] <= "9":
                    digits, groups = digits + d - c, groups + 1
                    if digits > MAX_DIGITS or groups > MAX_GROUPS:
                        break
                    if (kinds := _numeric_kinds(text[a:d], digits)):
                        out.append((i, j + 1, kinds))
                elif text[c] not in "+()-./" or (text[c] == "+" and j > i):
                    break
        if first.isalnum() and (i == 0 or tokens[i - 1][1] < a or not (text[a - 1].isalnum() or text[a - 1] in "._%+-")):
            at = False
            for j in range(i, min(n, i + MAX_TOKENS)):
                c, d = tokens[j]
                if j > i and c != tokens[j - 1][1]:
                    break
                if text[c] == "@":
                    if at:
                        break
                    at = True
                elif not text[c].isalnum() and text[c] not in "._%+-":
                    break
                elif at and text[c].isalnum():
                    out.append((i, j + 1, ("email",)))
    return out


def features(text: str, a: int, b: int) -> list[str]:
    """Features of the whole span text[a:b] and of its two neighbours."""
    s = text[a:b]
    digits = "".join(_DIGIT.findall(s))
    before, after = text[a - 1:a], text[b:b + 1]
    parts = re.split(r"[\s().+/-]+", s.strip("()+"))
    size = "0-3" if len(digits) < 4 else "4-6" if len(digits) < 7 else "7" if len(digits) < 8 else "8-9" if len(digits) < 10 else \
        "10-11" if len(digits) < 12 else "12-15" if len(digits) < 16 else "16-19" if len(digits) < 20 else "20"
    out = ["bias", f"digits {size}", f"parts {min(len(parts), 6)}", f"dots {min(s.count('.'), 5)}",
           f"luhn {len(digits) >= 15 and luhn(digits)} {size}", f"open {s.count('(') - s.count(')')}",
           f"edge {before.isalnum()} {after.isalnum()}", f"joined {before in tuple('.-/=:@#_+') and before != ''} {after in tuple('-/=:@#_') and after != ''}",
           f"spaces {min(s.count(' '), 4)}", f"hyphens {min(s.count('-'), 4)}"]
    if s[0] == "+":
        out.append("plus")
    if re.fullmatch(r"(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\) ?\d{3,4}[ .-]\d{3,4}", s):
        out.append("area code and two groups")
    if re.fullmatch(r"\d{4}(?:[ .-]\d{4}){3}", s):
        out.append("four groups of four")
    quads = s.split(".")
    if len(quads) == 4 and all(q.isdigit() and len(q) < 4 and int(q) < 256 for q in quads):
        out.append("four bytes")
    if "@" in s:
        local, _, domain = s.partition("@")
        labels = domain.split(".")
        out += [f"labels {min(len(labels), 5)}", f"top {labels[-1].isalpha() and len(labels[-1]) > 1}", f"ascii {s.isascii()}",
                f"local {local[0].isalnum()} {local[-1].isalnum()}"]
    return out


# ---------------------------------------------------------------- the model


class Lattice:
    """Segments of one window: O for every token, candidates, and fixed base spans."""

    def __init__(self, text: str, tokens: list[tuple[int, int]], fixed: list[Span]):
        self.tokens = tokens
        starts, ends = [c for c, _ in tokens], [d for _, d in tokens]
        covered, blocked = np.zeros(len(tokens) + 1, bool), np.zeros(len(tokens) + 1, bool)
        self.fixed = []               # base spans that overlap none before them
        for kind, a, b in sorted(fixed, key=lambda s: (s[1], -s[2])):
            i, j = bisect_right(ends, a), bisect_left(starts, b)
            if i < j:
                if not covered[i:j].any():
                    blocked[i:j] = True
                    self.fixed.append((i, j, LABELS.index(kind)))
                covered[i:j] = True
        self.segments = []            # (first, past, label, features)
        free = np.cumsum(np.r_[0, covered[:-1]])
        for i, j, kinds in candidates(text, tokens):
            if free[j] == free[i]:
                f = features(text, tokens[i][0], tokens[j - 1][1])
                self.segments += [(i, j, LABELS.index(k), f) for k in kinds]
        self.blocked = blocked

    def into(self, scores: list[float]) -> list[list[tuple[int, int, float, int]]]:
        """Segments by their end: (first, label, score, number of the segment or -1)."""
        ends: list[list] = [[] for _ in range(len(self.tokens) + 1)]
        for t in range(len(self.tokens)):
            if not self.blocked[t]:
                ends[t + 1].append((t, 0, 0.0, -1))
        for i, j, k in self.fixed:
            ends[j].append((i, k, 0.0, -1))
        for n, (i, j, k, _) in enumerate(self.segments):
            ends[j].append((i, k, scores[n], n))
        return ends


class Model:
    """Weights of (label, feature) and of label after label."""

    def __init__(self):
        self.w: dict[tuple[int, str], float] = {}
        self.a = np.zeros((len(LABELS), len(LABELS)))

    def scores(self, lattice: Lattice) -> list[float]:
        get = self.w.get
        return [sum(get((k, x), 0.0) for x in f) for _, _, k, f in lattice.segments]

    def decode(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation's entities that are no fixed ones."""
        if not lattice.segments:
            return []
        ends, n = lattice.into(self.scores(lattice)), len(lattice.tokens)
        best = np.full((n + 1, len(LABELS)), -np.inf)
        back: dict = {}
        best[0, 0] = 0.0
        for t in range(1, n + 1):
            for i, k, s, seg in ends[t]:
                came = best[i] + self.a[:, k]
                p = int(came.argmax())
                if came[p] + s > best[t, k]:
                    best[t, k], back[t, k] = came[p] + s, (i, p, seg)
        out, t, k = [], n, int(best[n].argmax())
        while t and (t, k) in back:
            i, p, seg = back[t, k]
            if seg >= 0:
                out.append((i, t, k))
            t, k = i, p
        return out[::-1]

    def gradient(self, lattice: Lattice, gold: set[tuple[int, int, int]]):
        """Log likelihood of the gold entities and its gradient."""
        scores = self.scores(lattice)
        ends, n, m = lattice.into(scores), len(lattice.tokens), len(LABELS)
        alpha, beta = np.full((n + 1, m), -np.inf), np.full((n + 1, m), -np.inf)
        alpha[0, 0] = 0.0
        for t in range(1, n + 1):
            for i, k, s, _ in ends[t]:
                alpha[t, k] = np.logaddexp(alpha[t, k], s + np.logaddexp.reduce(alpha[i] + self.a[:, k]))
        beta[n] = 0.0
        for t in range(n, 0, -1):
            for i, k, s, _ in ends[t]:
                beta[i] = np.logaddexp(beta[i], self.a[:, k] + s + beta[t, k])
        z = float(np.logaddexp.reduce(alpha[n]))
        da, expect, like = np.zeros_like(self.a), np.zeros(len(scores)), -z
        for t in range(1, n + 1):
            for i, k, s, seg in ends[t]:
                p = np.exp(alpha[i] + self.a[:, k] + s + beta[t, k] - z)
                da[:, k] -= p
                if seg >= 0:
                    expect[seg] += p.sum()
        chosen = {(i, j, k): n for n, (i, j, k, _) in enumerate(lattice.segments)}
        t, label = 0, 0
        starts = {i: (i, j, k) for i, j, k in gold if (i, j, k) in chosen} | {i: (i, j, k) for i, j, k in lattice.fixed}
        while t < n:
            i, j, k = starts.get(t, (t, t + 1, 0))
            if (i, j, k) in chosen:
                expect[chosen[i, j, k]] -= 1
                like += scores[chosen[i, j, k]]
            da[label, k] += 1
            like += self.a[label, k]
            t, label = j, k
        return like, da, expect


def _variants(text: str, spans: list[Span], rng) -> tuple[str, list[Span]] | None:
    """The text with one phone or card number written in another common way."""
    able = [s for s in spans if s[0] in ("phone", "card")]
    if not able:
        return None
    kind, a, b = able[rng.integers(len(able))]
    if any(s != (kind, a, b) and s[1] < b and s[2] > a for s in spans):
        return None
    old = text[a:b]
    if kind == "card":
        digits = "".join(_DIGIT.findall(old))
        new = (".", "/")[rng.integers(2)].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    elif (m := re.match(r"\+\d{1,3}[ .-]?(?=\()", old)):
        new = old[m.end():]
    else:
        return None
    shift = len(new) - len(old)
    moved = [(k, c + shift * (c >= b), d + shift * (c >= b)) for k, c, d in spans if (k, c, d) != (kind, a, b)]
    return text[:a] + new + text[b:], [*moved, (kind, a, a + len(new))]


def fit(texts: list[str], epochs: int = EPOCHS, seed: int = 3) -> Model:
    """A model of the base spans in the texts (AdaGrad on the log likelihood)."""
    rng, lattices = np.random.default_rng(seed), []

    def add(text: str, spans: list[Span]) -> None:
        for tokens, inside in windows(text, spans):
            lattice = Lattice(text, tokens, [])
            starts, past = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
            gold = {(starts[a], past[b], LABELS.index(k)) for k, a, b in inside if a in starts and b in past}
            if lattice.segments:
                lattices.append((lattice, gold))

    for text in texts:
        spans = base_spans(text)
        add(text, spans)
        if (v := _variants(text, spans, rng)):
            add(*v)
    model, seen, seen_a = Model(), {}, np.full((len(LABELS), len(LABELS)), 1e-2)
    for _ in range(epochs):
        for n in rng.permutation(len(lattices)):
            lattice, gold = lattices[n]
            _, da, expect = model.gradient(lattice, gold)
            da -= 1e-3 * model.a
            seen_a += da * da
            model.a += 0.3 * da / np.sqrt(seen_a)
            for (_, _, k, f), e in zip(lattice.segments, expect, strict=True):
                if abs(e) > 1e-4:
                    for x in f:
                        g = -e - 1e-3 * model.w.get((k, x), 0.0)
                        seen[k, x] = seen.get((k, x), 1e-2) + g * g
                        model.w[k, x] = model.w.get((k, x), 0.0) + 0.3 * g / seen[k, x] ** 0.5
    return model


def find(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by kind, then start."""
    base = base_spans(text)
    if not base and not _TRIGGER.search(text):
        return base, base
    added = []
    for tokens, inside in windows(text, base):
        lattice = Lattice(text, tokens, inside)
        for i, j, k in model.decode(lattice):
            added.append((LABELS[k], tokens[i][0], tokens[j - 1][1]))
    order = {k: n for n, k in enumerate(KINDS)}
    return base, sorted({*base, *added}, key=lambda s: (order[s[0]], s[1], s[2])) if added else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans by the first's."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


# ---------------------------------------------------------------- Spark


def train(docs: DataFrame, size: int = SAMPLE) -> Model:
    """A model of at most ``size`` distinct texts that hold a trigger, by the hash of
    the text; texts longer than ``PIECE`` are cut into pieces, each a text of its own.
    Copies are one text, merged before the driver sees them."""
    starts = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / PIECE).cast("int"))
    pieces = F.transform(starts, lambda k: F.substring(F.col("text"), k * PIECE + 1, F.lit(PIECE)))
    texts = (docs.select(text_of().alias("text")).where(F.col("text").rlike("[0-9@]"))
             .select(F.explode(F.when(F.char_length("text") <= PIECE, F.array("text")).otherwise(pieces)).alias("text"))
             .where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h")))
    distinct = texts.agg(F.approx_count_distinct("h")).first()[0]
    rows = texts.where(lowest_hashes(F.col("h"), distinct, size)).groupBy("h").agg(F.min("text").alias("text")).collect()
    return fit([r["text"] for r in sorted(rows)[:size]])


def spans(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end) of every text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(found):
            return [{"kind": k, "start": a, "end": b} for k, a, b in found]
        for b in batches:
            found = [find(t, shared.value) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "base": [rows(x) for x, _ in found], "spans": [rows(y) for _, y in found]})

    return map_documents(df.select("doc_id", text_of().alias("text")), run, f"base {kind}, spans {kind}")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with every span replaced by its kind; n_chars follows the text.
    A NULL text stays NULL."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else masked(t, find(t, shared.value)[1]))

    out = docs.withColumn("text", clean(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return out
