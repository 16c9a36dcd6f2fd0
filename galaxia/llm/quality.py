"""Quality rules by host (DataFrame functions only).

Each document is measured once, in place: words, symbols, repeated lines, and
words in repeated three-word windows.  Rule failures are then counted by host
(the ``source`` column), each host's failure rates are shrunk towards all hosts
by an empirical beta prior, and hosts whose shrunk rate of any rule is above a
limit fail.  The limit is the prior's mean and ``HOST_SPREADS`` of its standard
deviations, ``HOST_MAX_RATE`` at most: hosts are judged against what hosts of the
corpus usually do; the verdict is joined back to the documents.  A host
with few documents therefore needs several failures before it is judged, and a
hot host is one row per map task before the shuffle.

Defined results: NULL or empty text has no words and fails the base rule; a NULL
host is a host of its own; an empty table gives an empty result; repeated rows
are measured and judged each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import NON_WS, WS, packed, text_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rules that count towards a host only.
MAX_SYMBOLS_PER_100_WORDS = 50
MAX_DUP_LINE_PERCENT = 50
HOST_MAX_RATE = 0.75
HOST_SPREADS = 3.0
RULES = ("short", "repeats", "symbols", "dup_lines")
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: str, hashes: str):
    """Words covered by three-word windows that occur twice or more.  Windows are
    sorted by hash with their positions; neighbours of one hash are repeats."""
    n = F.size(hashes)
    windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(w):   # w: the sorted windows, bound once
        hit = F.filter(w, lambda x, k: ((k > 0) & (F.get(w, k - 1)["h"] == x["h"])) |
                       ((k < F.size(w) - 1) & (F.get(w, k + 1)["h"] == x["h"])))
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    some = n > F.size(F.array_distinct(hashes))
    return F.when(some, F.get(F.transform(F.array(windows), covered), 0)).otherwise(0).cast("long")


def measure(df: DataFrame, carry: list[str]) -> DataFrame:
    """The carried columns and the metrics of each document."""
    t = text_of()
    word_lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NON_WS))
    base = (df.select(*carry, t.alias("text"))
            .select(*carry, F.regexp_extract_all("text", F.lit(NON_WS + "+"), F.lit(0)).alias("words"),
                    word_lines.alias("word_lines"),
                    F.char_length(F.regexp_replace("text", WS + "+", "")).cast("long").alias("word_chars"),
                    F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols")))
    hashes = F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))),
                    lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    return (base.withColumn("hashes", hashes)
            .select(*carry, F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
                    (F.size("word_lines") - F.size(F.array_distinct("word_lines"))).cast("long").alias("n_dup_lines"),
                    F.size("word_lines").cast("long").alias("n_word_lines"),
                    _repeat_words("words", "hashes").alias("n_repeat_words")))


def failures(measured: DataFrame) -> DataFrame:
    rules = {"short": F.col("n_words") < MIN_WORDS,
             "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
             "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS_PER_100_WORDS * F.col("n_words"),
             "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_word_lines")}
    out = measured.withColumns(rules)
    return out.withColumn("base_failed", F.col("short") | F.col("repeats"))


def host_verdicts(failed: DataFrame, max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """One row per host: its documents, failures and shrunk rate per rule, and
    ``host_ok``.  The prior Beta(a, b) of a rule is fitted over the hosts by the
    method of moments; a + b is 1 at least and the number of documents at most."""
    hosts = materialize(failed.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(f"k_{r}") for r in RULES]), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"),
                      *[F.sum(f"k_{r}").alias(f"k_{r}") for r in RULES],
                      *[F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / F.col("n")).alias(f"q_{r}") for r in RULES]).first()
    out, ok = hosts, F.lit(True)
    for r in RULES:
        a, b = beta_prior(total["n"] or 0, total["hosts"] or 0, total[f"k_{r}"] or 0, total[f"q_{r}"] or 0.0)
        rate = (F.col(f"k_{r}") + a) / (F.col("n") + a + b)
        out, ok = out.withColumn(f"rate_{r}", rate), ok & (rate <= host_limit(a, b, max_rate))
    return out.withColumn("host_ok", ok)


def host_limit(a: float, b: float, max_rate: float = HOST_MAX_RATE) -> float:
    """The rate above which a host fails under the prior Beta(a, b)."""
    mean = a / (a + b)
    return min(max_rate, mean + HOST_SPREADS * (mean * (1 - mean) / (a + b + 1)) ** 0.5)


def beta_prior(n: int, hosts: int, k: int, q: float) -> tuple[float, float]:
    """n documents of which k failed, on so many hosts; q = sum of k_h^2 / n_h.
    Moments of a beta-binomial, hosts weighed by their documents."""
    if n == 0:
        return 0.5, 0.5
    mean = k / n
    if hosts < 2 or k in (0, n):
        return max(mean, 1e-9), max(1 - mean, 1e-9)
    spread = q / n - mean * mean                       # between hosts, sampling included
    chance = mean * (1 - mean) * hosts / n             # what sampling alone gives
    strength = (mean * (1 - mean) - spread) / max(spread - chance, 1e-12)
    strength = min(max(strength, 1.0), float(n))
    return mean * strength, (1 - mean) * strength


def quality_rules(df: DataFrame, host: str = "source", carry: list[str] | None = None,
                  max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """Per document: doc_id, the carried columns, the metrics, base_failed,
    host_ok and kept."""
    own = ["doc_id", "host", *(carry or [])]
    rows = df.select("doc_id", "text", F.col(host).alias("host"), *(carry or []))
    failed = materialize(failures(measure(rows, own)), "quality")
    hosts = materialize(host_verdicts(failed, max_rate).select(F.col("host").alias("verdict_of"), "host_ok"), "host-verdicts")
    return (failed.join(hosts, F.col("host").eqNullSafe(F.col("verdict_of")), "left")
            .select("doc_id", *(carry or []), *METRICS, "base_failed", "host_ok",
                    (~F.col("base_failed") & F.col("host_ok")).alias("kept")))


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, with all their columns."""
    rows = packed(docs).withColumn("source", F.col("row.source"))
    kept = quality_rules(rows, carry=["rk"]).where("kept").select("rk", F.col("doc_id").alias("id")).distinct()
    same = (F.col("d.rk") == F.col("k.rk")) & F.col("d.doc_id").eqNullSafe(F.col("k.id"))
    return rows.alias("d").join(kept.alias("k"), same, "left_semi").select("row.*")


def _oracle() -> str:
    sums = ", ".join(f"sum({r}::int) AS k_{r}" for r in RULES)
    totals = ", ".join(f"sum(k_{r}) AS k_{r}, sum(k_{r} * k_{r} / n) AS q_{r}" for r in RULES)
    prior = []
    for r in RULES:
        m = f"(k_{r} / n)"
        strength = (f"least(greatest(({m} * (1 - {m}) - (q_{r} / n - {m} * {m})) / "
                    f"greatest(q_{r} / n - {m} * {m} - {m} * (1 - {m}) * hosts / n, 1e-12), 1.0), n)")
        flat = f"hosts < 2 OR k_{r} = 0 OR k_{r} = n"
        prior.append(f"CASE WHEN {flat} THEN greatest({m}, 1e-9) ELSE {m} * {strength} END AS a_{r}, "
                     f"CASE WHEN {flat} THEN greatest(1 - {m}, 1e-9) ELSE (1 - {m}) * {strength} END AS b_{r}")
    mean = {r: f"(a_{r} / (a_{r} + b_{r}))" for r in RULES}
    limit = {r: f"least({HOST_MAX_RATE}, {mean[r]} + {HOST_SPREADS} * sqrt({mean[r]} * (1 - {mean[r]}) / (a_{r} + b_{r} + 1)))" for r in RULES}
    ok = " AND ".join(f"(h.k_{r} + a_{r}) / (h.n + a_{r} + b_{r}) <= {limit[r]}" for r in RULES)
    return rf"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS tri
  FROM t WHERE len(w) >= 3),
r AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM r GROUP BY doc_id),
m AS (
  SELECT t.doc_id, source, len(w)::bigint AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::bigint AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN c USING (doc_id)),
f AS (
  SELECT *, n_words < {MIN_WORDS} AS short, 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS repeats,
         100 * n_symbols > {MAX_SYMBOLS_PER_100_WORDS} * n_words AS symbols, 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS dup_lines
  FROM m),
h AS (SELECT source, count(*)::double AS n, {sums} FROM f GROUP BY source),
s AS (SELECT sum(n) AS n, count(*) AS hosts, {totals} FROM h),
p AS (SELECT {', '.join(prior)} FROM s),
v AS (SELECT h.source, {ok} AS host_ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (short OR repeats) AS base_failed, host_ok,
       NOT (short OR repeats) AND host_ok AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


ORACLE = _oracle()
