"""Which files a run takes in: each version of a file once.

A file's identity is its path, length and modification time. What the runs have
done with files is kept in tables that the commit record names: one row per file
and run, status 'I' (taken in) or 'Q' (set aside). A later run leaves out every
file whose latest row has the same identity. A file that changed is taken in
anew, and the rows of its former version are retracted. Every few runs the tables
are replaced by one with the latest row of each file, so a lookup reads that and
the runs since, never the whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.contracts import STATUS_DONE, STATUS_SET_ASIDE
from tillroll.sinks.commits import State

IDENTITY = ("file_path", "length", "modification_time")
DONE = ("file_path string, length bigint, modification_time timestamp, status string, "
        "reason string, run_id string, rows_run string, seq bigint")
#: Column of the marts that names the file version a row came from.
FILE_KEY = "_file_key"
COMPACT_AFTER = 10


def file_key(path: Column | str, run_id: Column) -> Column:
    """A file as one run took it in."""
    return F.xxhash64(path, run_id)


def finished(spark: SparkSession, root: str, state: State) -> DataFrame:
    """The latest row of each file (columns of DONE). ``rows_run`` is the run whose rows of the file count; null if none."""
    if not state.done:
        return spark.createDataFrame([], DONE)
    rows = spark.read.schema(DONE).parquet(*[f"{root}/{p}" for p in state.done])
    return rows.groupBy("file_path").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "file_path"]), "seq").alias("d")).select("file_path", "d.*")


def with_known(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """A manifest with ``known``: null for the files that no run has done with as they are, else
    the reason for which one is set aside, or 'done'."""
    before = done.select(*IDENTITY, F.coalesce("reason", F.lit("done")).alias("known"))
    return manifest.join(before, list(IDENTITY), "left").select(*manifest.columns, "known")


def outcome(routed: DataFrame, done: DataFrame, run_id: str, seq: int) -> DataFrame:
    """Rows of DONE for the files that a run routed. A file set aside leaves the rows of its former version standing."""
    before = done.select("file_path", F.col("rows_run").alias("before"))
    status = F.when(F.col("ok"), STATUS_DONE).otherwise(STATUS_SET_ASIDE)
    return routed.join(before, "file_path", "left").select(
        *IDENTITY, status.alias("status"), "reason", F.lit(run_id).alias("run_id"),
        F.when(F.col("ok"), F.lit(run_id)).otherwise(F.col("before")).alias("rows_run"), F.lit(seq).cast("bigint").alias("seq"))


def superseded(routed: DataFrame, done: DataFrame) -> DataFrame:
    """(file_path, rows_run, FILE_KEY) of the former versions of accepted files."""
    former = routed.filter("ok").select("file_path").join(done.filter("rows_run IS NOT NULL"), "file_path")
    return former.select("file_path", "rows_run", file_key("file_path", F.col("rows_run")).alias(FILE_KEY))


def key_clash(old: DataFrame, done: DataFrame) -> bool:
    """Whether the key of a superseded file is that of another file whose rows count."""
    standing = done.filter("rows_run IS NOT NULL").select(F.col("file_path").alias("other"), file_key("file_path", F.col("rows_run")).alias(FILE_KEY))
    return not standing.join(old, FILE_KEY).where("other <> file_path").isEmpty()
