"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

1. A text without ASCII white space is cut where its own content says so: a
   chunk ends at the first trigger pair after ``MIN_CHUNK`` code points, or at
   ``MAX_CHUNK``.  Equal texts have equal chunks wherever they stand.
2. Chunk texts move once, each distinct one once per map task, to be verified:
   a 64-bit hash that stands for exactly one text is that chunk's identifier; a
   hash shared by several texts gets a second hash beside it, and the job fails
   should both agree for different texts.
3. A document then is its recipe, the ordered list of identifiers.  Grouping and
   joining compare recipes; no document text moves again.

Copies in huge groups are pre-aggregated per map task, and the join of the
groups back to the documents is a plain one that AQE splits on a hot recipe.

Defined results: NULL text counts as empty; empty texts form one group; of rows
that tie in length and id exactly one is kept; a NULL id sorts after all others;
an empty table gives an empty result; other columns are ignored unless carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WS, packed, text_of

MIN_CHUNK = 512
MAX_CHUNK = 4096
#: A pair that ends a chunk: about one position in a hundred of Latin prose.
TRIGGER = "[t-z][a-d]"


def chunk_pattern() -> str:
    return (f"(?s).{{{MIN_CHUNK}}}.{{0,{MAX_CHUNK - MIN_CHUNK}}}?{TRIGGER}|.{{1,{MAX_CHUNK}}}")


def _chunked(df: DataFrame, carry: list[str]) -> DataFrame:
    norm = F.regexp_replace(text_of(), WS + "+", "")
    return (df.select("doc_id", *carry, F.char_length(text_of()).alias("n_points"), norm.alias("norm"))
            .withColumn("chunks", F.regexp_extract_all("norm", F.lit(chunk_pattern()), F.lit(0))))


def _hash(bits: int):
    """Chunk hash; fewer bits only in tests, to make hashes collide."""
    h = F.xxhash64("chunk")
    return h if bits == 64 else F.shiftrightunsigned(h, 64 - bits)


def shared_hashes(df: DataFrame, bits: int = 64) -> DataFrame:
    """Verification: hashes that stand for more than one chunk text."""
    texts = (_chunked(df, []).select(F.explode("chunks").alias("chunk"))
             .select(_hash(bits).alias("h"), F.xxhash64(F.lit("second"), "chunk").alias("h2"), "chunk")
             .distinct())
    found = texts.groupBy("h").agg(F.count("*").alias("texts"), F.countDistinct("h2").alias("second"))
    return (found.where("texts > 1")
            .select("h", F.when(F.col("texts") > F.col("second"), F.raise_error(F.lit("two chunk hashes agree for different texts")))
                    .otherwise(F.lit(True)).cast("boolean").alias("shared")))


def recipes(df: DataFrame, carry: list[str] | None = None, bits: int = 64) -> DataFrame:
    """One row per document: ``row_id``, doc_id, n_points, text_sha256, the carried
    columns and ``recipe``, its ordered list of verified identifiers."""
    carry = carry or []
    shared = materialize(shared_hashes(df, bits), "chunk-hashes")
    own = ["row_id", "doc_id", "n_points", "text_sha256", *carry]
    parts = (_chunked(df, carry)
             .withColumn("row_id", F.monotonically_increasing_id())
             .withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
             .select(*own, F.posexplode_outer("chunks").alias("pos", "chunk"))
             .select(*own, "pos", _hash(bits).alias("h"), F.xxhash64(F.lit("second"), "chunk").alias("h2")))
    ident = F.struct("pos", "h", F.when(F.col("shared"), F.col("h2")).alias("h2"))
    return (parts.join(shared, "h", "left")
            .groupBy(*own)
            .agg(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), ident))).alias("parts"))
            .select(*own, F.transform("parts", lambda p: F.struct(p["h"].alias("h"), p["h2"].alias("h2"))).alias("recipe")))


def exact_dedup(df: DataFrame, carry: list[str] | None = None, bits: int = 64) -> DataFrame:
    """Per document: doc_id, the carried columns, keep_id, group_size, kept and
    text_sha256.  Of equal texts the one with the most code points stays, then
    the smallest id."""
    carry = carry or []
    table = materialize(recipes(df, carry, bits), "recipes")
    # smallest struct = most code points, then smallest id (NULL last), then one row
    rank = F.struct(-F.col("n_points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    groups = materialize(table.groupBy("recipe").agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
                         .where("group_size > 1"), "recipe-groups")
    found = table.join(groups, "recipe", "left")
    single = F.col("group_size").isNull()
    return found.select("doc_id", *carry,
                        F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
                        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        (single | (F.col("best.row_id") == F.col("row_id"))).alias("kept"),
                        "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = packed(docs)
    kept = exact_dedup(rows, ["rk"]).where("kept").select("rk", F.col("doc_id").alias("id"))
    same = (F.col("d.rk") == F.col("k.rk")) & F.col("d.doc_id").eqNullSafe(F.col("k.id"))
    return (rows.alias("d").join(kept.alias("k"), same, "left_semi")
            .dropDuplicates(["rk", "doc_id"]).select("row.*"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""
