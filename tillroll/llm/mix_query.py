"""The source mix of ``documents``: schedule, query and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .source_mix import REPEATS, WHOLE, plan_mix
from .util import table


def cycling_schedule(docs: DataFrame) -> DataFrame:
    """Sources by code point, null last, weigh 1, 2, 3, repeating, over the whole run.

    Of each three, the first begins at 2 and ends at 0 and the second begins at
    1 and ends at 3: the sums of all weights are the same at both ends, so the
    integrals keep the proportion.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))  # a row for each source
    sources = docs.select("source").distinct().select("source", (place - 1).alias("i"))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    w = F.col("i") % 3 + 1
    begin = F.when((w == 1) & (F.col("i") + 1 < F.col("n")), 2).when(w == 2, 1).otherwise(w)
    return sources.withColumn("n", n).select("source", F.array(begin, 2 * w - begin).cast("array<double>").alias("weights"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = plan_mix(docs, cycling_schedule(docs), keep=["doc_id"])
    first = F.get("copies", F.lit(0))["position"]
    return rows.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position"),
                       F.size("copies").cast("long").alias("n_copies")).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


#: The same by window functions over all rows; the sharing by one sort of the sources.
SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
i AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS i, count(*) OVER () AS n FROM s),
w AS (
  SELECT *, (i % 3 + 1)::DOUBLE AS w, CASE WHEN i % 3 = 0 AND i + 1 < n THEN 2 WHEN i % 3 = 1 THEN 1 ELSE i % 3 + 1 END::DOUBLE AS w0 FROM i),
p AS (SELECT *, w0 / sum(w0) OVER () AS p0, (2 * w - w0) / sum(2 * w - w0) OVER () AS p1 FROM w),
a AS (SELECT *, (p0 + p1) * 0.5::DOUBLE AS area, floor((p0 + p1) * 0.5::DOUBLE * {WHOLE!r}::DOUBLE)::BIGINT AS weight, {REPEATS} * source_size AS most FROM p),
o AS (
  SELECT *, coalesce(sum(most) OVER before, 0)::BIGINT AS most_before, coalesce(sum(weight) OVER before, 0)::BIGINT AS weight_before,
    sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights
  FROM a WINDOW before AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, most::DOUBLE * (weights - weight_before)::DOUBLE < weight::DOUBLE * (total - most_before)::DOUBLE AS above FROM o),
t AS (
  SELECT *, CASE WHEN above THEN most::DOUBLE ELSE weight::DOUBLE * (total - coalesce(sum(most) FILTER (above) OVER (), 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) FILTER (above) OVER (), 0))::DOUBLE END AS target FROM c),
g AS (SELECT *, floor(target)::BIGINT AS whole, sum(floor(target)::BIGINT) OVER ()::DOUBLE AS run FROM t),
r AS (
  SELECT d.doc_id, d.size, g.*, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
e AS (SELECT *, start / target * area AS due FROM r)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN list_sum(list_transform(range(0, {REPEATS}), lambda e: greatest(least(size, whole - e * source_size - start), 0))) ELSE 0 END)::BIGINT AS taken,
  CASE WHEN size > 0 AND start < whole THEN floor(
    (CASE WHEN due > 0 THEN least(due * 2.0::DOUBLE / (p0 + sqrt(greatest(p0 * p0 + (p1 - p0) * 2.0::DOUBLE * due / 1.0::DOUBLE, 0))), 1) ELSE 0 END) * run)::BIGINT END AS first_position,
  (CASE WHEN size > 0 THEN len(list_filter(range(0, {REPEATS}), lambda e: e * source_size + start < whole)) ELSE 0 END)::BIGINT AS n_copies
FROM e
"""
