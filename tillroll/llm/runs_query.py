"""Runs of ``documents``, of which a tenth repeat a part of themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .periodic_runs import find_runs
from .source_mix import WORD
from .util import table


def repeating(docs: DataFrame) -> DataFrame:
    """Documents whose crc32 (of doc_id as text) divides by 10 go on, from a word given by it, with a part of themselves."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    marked = docs.withColumn("words", F.when(h % 10 == 0, words))

    def some(c: Column) -> Column:
        return F.when(F.size("words") > 0, c)

    n = F.size("words").cast("long")
    a = some(g % n)
    p = some(F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    marked = marked.withColumns({"a": a.cast("int"), "p": p})
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), (n - F.col("a")).cast("int"))), " ")
    return marked.select("doc_id", F.when(F.col("p").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_runs(repeating(table(spark, sf_dir, "documents")).select("doc_id", "text"))
    runs = F.col("periodic.runs")
    # The greatest length, then the smallest start and period.
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    rows = rows.withColumn("best", best)
    length, start, period = F.col("best.length"), -F.col("best.s"), -F.col("best.p")
    return rows.select("doc_id", F.size(runs).cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "periodic.runs_sha256", "periodic.collapsed_sha256")
