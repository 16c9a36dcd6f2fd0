"""The registered queries of the training-data operators and their DuckDB SQL.
Each query runs its operator over whole tables with production parameters and
derives the columns of its contract from the operator's own output."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe_words, exact_dedup, kneser_ney, langid, line_dedup, packing, pii, prefix_trie, quality, simhash, spelling, suffix_dedup, toxicity
from .common import documents


def op1_kneser_ney(spark, sf_dir):
    return kneser_ney.lm_scores(documents(spark, sf_dir))


def op2_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        F.size("spans").alias("n_spans"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(documents(spark, sf_dir))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op6_pii(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = pii.spans(docs, pii.train(docs))

    def listed(name):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op7_line_dedup(spark, sf_dir):
    out = line_dedup.line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    net = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, net).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                                            (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_rules(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir))


def op10_bpe_words(spark, sf_dir):
    out = bpe_words.round_trip(documents(spark, sf_dir))
    return out.select("doc_id", "n_tokens", F.sha2(F.col("ids_text").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(spelling.corpus_words(documents(spark, sf_dir)))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {f.__name__: f for f in (op1_kneser_ney, op2_language_id, op3_best_fit_packing, op4_exact_dedup, op5_simhash, op6_pii, op7_line_dedup, op8_toxicity, op9_quality_rules, op10_bpe_words,
                                  op11_spelling_variants, op12_prefix_trie, op13_suffix_dedup)}
ORACLE = {"op4_exact_dedup": exact_dedup.ORACLE, "op7_line_dedup": line_dedup.ORACLE, "op9_quality_rules": quality.ORACLE}
