"""Line dedup: explode normalised lines, hash, count distinct documents per
hash, drop lines over the threshold, reassemble by position.

Only ids, positions and 128-bit line hashes move through the counting; the text
is joined once, to the flags of its own lines, and put together in place.  A
line that a third of all documents hold is one row per document after the first
aggregation, one row per map task after the second, and its join back to the
lines is one that AQE splits.  The text meets its flags in a merge join at every
size: what is moved and kept on disk then grows with the documents, not by a jump
where the flags no longer fit a broadcast.

Defined results: NULL or empty text is one empty line; rows with the same id and
text get the same result each; a NULL id counts as one document that is smaller
than any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WS, text_of

MIN_POINTS = 20
MIN_DOCS = 3
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _key(line):
    return F.regexp_replace(line, f"^{WS}+|{WS}+$", "")


def line_rows(df: DataFrame) -> DataFrame:
    """Every line: doc_id, th (hash of its text), pos, and the 128-bit hash of its
    key where the key is long enough (else NULL)."""
    t = text_of()
    rows = (df.select("doc_id", F.xxhash64(t).alias("th"), F.posexplode(F.split(t, "\n")).alias("pos", "line"))
            .select("doc_id", "th", "pos", _key(F.col("line")).alias("key")))
    rows = rows.withColumn("key", F.when(F.char_length("key") >= MIN_POINTS, F.translate("key", _UPPER, _UPPER.lower())))
    return rows.select("doc_id", "th", "pos", F.when(F.col("key").isNotNull(), F.xxhash64("key")).alias("h1"),
                       F.when(F.col("key").isNotNull(), F.xxhash64(F.lit("line"), "key")).alias("h2"))


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Line hashes held by at least ``min_docs`` documents, with the largest of them."""
    per_doc = lines.where("h1 IS NOT NULL").select("h1", "h2", "doc_id").distinct()
    return (per_doc.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last_doc"))
            .where(F.col("docs") >= min_docs).select("h1", "h2", "last_doc"))


def line_dedup(df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and ``kept``, the text left."""
    frequent = materialize(frequent_lines(line_rows(df), min_docs), "frequent-lines")
    dropped = (line_rows(df).where("h1 IS NOT NULL").join(frequent, ["h1", "h2"])
               .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
               .groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone")))
    dropped = materialize(dropped, "dropped-lines")
    t = text_of()
    docs = df.select("doc_id", F.xxhash64(t).alias("th"), t.alias("text"))
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.th") == F.col("g.th"))
    found = docs.alias("d").join(dropped.alias("g").hint("merge"), same, "left").select("d.doc_id", "text", "gone")
    lines = F.split("text", "\n")
    flagged = found.withColumn("lines", lines)
    # positions of the lines left, in order; array_except hashes, so long documents stay linear
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return flagged.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                          F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
                          F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.last_doc AS gone
  FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
