"""The corpus pipeline: each stage calls one operator on all its predecessor
kept; its result is written as Parquet and is the next stage's input.

All stages but the last return the columns of ``documents``, whatever else the
table carries; operators work on the whole row as one struct, so names cannot
clash.  NULL texts, repeated rows and empty tables pass as the operators define.
"""

from __future__ import annotations

import uuid

from galaxia.llm import exact_dedup, packing, pii, quality, simhash
from galaxia.session import scratch_root


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules or their host's verdict reject go."""
    return quality.drop_rejected(docs)


def exact_copies(spark, docs, sf_dir):
    """Of documents with equal texts one stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Of each component of near fingerprints one document stays."""
    return simhash.drop_near_copies(docs)


def personal_data(spark, docs, sf_dir):
    """Spans of personal data are replaced by their kind."""
    return pii.redact(docs)


def packed_sequences(spark, docs, sf_dir):
    """The documents' pieces, packed into sequences."""
    return packing.best_fit_packing(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("simhash", near_copies),
          ("pii", personal_data), ("packing", packed_sequences)]

#: Fingerprints, spans and bins are not expressible in SQL: tested by brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{scratch_root(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def pipeline(spark, sf_dir):
    return run(spark, sf_dir)
