"""Registered queries of the operators: each applies one, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import mix_query, phrases_query, sql
from .decontamination import find_contamination
from .html_extraction import extract_main_text, fit_pages
from .jaccard_join import ngram_jaccard_join
from .language_id import learn_and_identify
from .mix_query import op11_source_mix
from .phrases_query import op13_phrase_collocations
from .quality_classifier import learn_and_grade
from .quality_rules import quality_rules
from .runs_query import op12_periodic_runs
from .secret_scan import BASE, find_secrets, joined_spans
from .sentencepiece_unigram import encode_texts
from .toxicity import learn_and_score
from .url_filter import filter_urls
from .util import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("rejected_by", F.concat_ws(",", "rejected_by"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 for quality 0, 1 for good but toxic documents, 2 for the rest; from 1 on they are wanted."""
    labels = table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return learn_and_grade(table(spark, sf_dir, "documents"), labels.select("doc_id", grade.alias("grade")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, fit_pages(pages))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_secrets(table(spark, sf_dir, "documents")).select("doc_id", "__secrets")
    base = F.filter("__secrets", lambda x: x["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("__secrets", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"),
                       joined_spans(F.col("__secrets")).alias("spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn_and_identify(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", (F.size("__found") > 0).alias("contaminated"), F.col("__found.item_id").alias("item_ids"),
                       F.coalesce(F.array_max("__found.similarity"), F.lit(0.0)).alias("similarity"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_ngram_jaccard_join, op3_url_filter, op4_quality_classifier, op5_html_extraction, op6_secret_scan,
                            op7_language_id, op8_decontamination, op9_sentencepiece, op10_toxicity, op11_source_mix, op12_periodic_runs, op13_phrase_collocations, pipeline)}
SQL: dict[str, str] = {**sql.SQL, "op11_source_mix": mix_query.SQL, "op13_phrase_collocations": phrases_query.SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
