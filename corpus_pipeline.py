"""A training corpus from ``documents``: rule-based quality, near-copies, benchmark leaks, secrets, pieces.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.decontamination import drop_contaminated
from tillroll.llm.jaccard_join import drop_near_copies
from tillroll.llm.quality_rules import keep_good
from tillroll.llm.secret_scan import redact_secrets
from tillroll.llm.sentencepiece_unigram import encode_texts
from tillroll.llm.util import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts, the row with the smallest doc_id. Texts that share a doc_id
    but are no copies stay, and so do documents without an id or a word."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced and n_chars counted again."""
    out = redact_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, n_tokens and lossless of every document."""
    return encode_texts(docs)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_copies), ("decontamination", decontaminate),
          ("secret_scan", secrets), ("sentencepiece", pieces)]

#: Fingerprints, components and pieces have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
