"""Shared pieces of the operators: tables, staging, connected components, id filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once under the cluster's shared folder and read back: lineage ends there,
    so a lost executor costs a re-read. The rows are whole; only the lineage is cut."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (columns a, b): component is the smallest id reachable.

    Each round points every vertex at its smallest neighbour, follows the pointers
    to their roots and contracts the graph to the roots, which at least halves the
    vertices that still have edges. Everything stays in Spark tables.
    """
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("id", "to")
        up = staged(both.groupBy("id").agg(F.least("id", F.min("to")).alias("up")), "up")
        while True:
            over = up.select(F.col("id").alias("up"), F.col("up").alias("over"))
            jumped = staged(up.join(over, "up").select("id", F.col("over").alias("up"), (F.col("over") != F.col("up")).alias("moved")), "up")
            up = jumped.select("id", "up")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = up.toDF("id", "component")
        else:
            later = up.toDF("component", "root")
            found = found.join(later, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        a, b = up.toDF("a", "ra"), up.toDF("b", "rb")
        edges = staged(edges.join(a, "a").join(b, "b").where("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return staged(found, "components")


def id_filter(ids: DataFrame, column: str, bits: int = 23) -> np.ndarray:
    """A bitmap of 2**bits bits (1 MB by default, whatever the input) that has the hash of every id.

    It only spares shuffling rows that surely have no match; a join decides.
    """
    h = F.pmod(F.xxhash64(column), F.lit(2 ** bits)) + 1  # the bitmap functions count from 1
    rows = (ids.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("n"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("b")).collect())
    out = np.zeros(2 ** bits // 8 + 4096, np.uint8)
    for n, b in rows:
        at = (n - 1) * 4096
        out[at:at + 4096] |= np.frombuffer(bytes(b), np.uint8)
    return out


def rows_in_filter(df: DataFrame, column: str, bitmap: np.ndarray, bits: int = 23) -> DataFrame:
    """The rows whose id may be in ``id_filter``'s bitmap, chosen before any shuffle."""
    held = df.sparkSession.sparkContext.broadcast(bitmap)

    def keep(batches):
        for batch in batches:
            h = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            one = (held.value[h >> 3] >> (h & 7).astype(np.uint8)) & 1
            yield batch.filter(one.astype(bool)).drop_columns(["__h"])

    hashed = df.withColumn("__h", F.pmod(F.xxhash64(column), F.lit(2 ** bits)))
    return hashed.mapInArrow(keep, df.schema)
