"""Set rejected files aside as data, with the reason, instead of moving them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.contracts import STATUS_SET_ASIDE
from tillroll.operators import intake
from tillroll.sinks import commits
from tillroll.sources.sales_csv import endless, file_lines, folder_of

FILES = "file_path string, file_name string, reason string, length bigint, n_lines bigint"
LINES = "file_path string, raw_line string, reason string"


def quarantine(spark: SparkSession, routed: DataFrame, out: str | None = None,
               run_id: str | None = None, listed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split off files that failed the route checks.

    Returns (files, lines): ``files`` has one row per set-aside file
    (path, name, reason, length, n_lines); ``lines`` holds every line of the
    set-aside CSV files that is not blank (one scan of their folders), so nothing is
    lost; a file without a line end stays where it is and is only named. With ``out`` both are written as Parquet under ``out/files`` and
    ``out/lines`` (in a ``run_id=<id>`` folder when a run id is given, so a
    redone run replaces its own rows); readers later read only ``ok`` paths,
    so the source files need not be moved. Paths are matched exactly, never
    by suffix.
    """
    bad = routed.filter(~F.col("ok"))
    files = bad.select("file_path", "file_name", "reason", "length", "n_lines")
    # Folders, not paths, reach the driver. Only names that Spark's readers see
    # have lines to read, and a file without a line end is not read at all.
    lined = bad.filter(F.col("is_csv") & (F.col("length") > 0) & ~F.col("reason").isin("hidden", "empty", "no_line_end"))
    folders = [r[0] for r in lined.select(folder_of("file_path")).distinct().collect()]
    if folders:
        lines = file_lines(spark, lined.select("file_path", "length", "modification_time", "reason"), folders,
                           endless(routed, folders, listed), header=True).select("file_path", F.col("line").alias("raw_line"), "reason")
    else:
        lines = spark.createDataFrame([], LINES)
    if out is not None:
        if run_id is not None:
            # Keyed by run: redoing a failed run replaces its own rows only.
            files.write.mode("overwrite").parquet(f"{out}/files/run_id={run_id}")
            lines.write.mode("overwrite").parquet(f"{out}/lines/run_id={run_id}")
        else:
            files.write.mode("append").parquet(f"{out}/files")
            lines.write.mode("append").parquet(f"{out}/lines")
    return files, lines


def set_aside(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(files, lines) that are set aside now, over all committed runs of a job's output root.

    Each version of a file was kept once, by the run that first saw it. A file is
    released when a version of it is accepted; an older version that is replaced by
    another bad one is no longer shown.
    """
    state = commits.load(spark, root)
    now = intake.finished(spark, root, state).filter(F.col("status") == STATUS_SET_ASIDE).select("file_path", "run_id")

    def current(kind: str, schema: str) -> DataFrame:
        paths = [f"{root}/{r[kind]}" for r in state.runs.values() if kind in r]
        rows = spark.read.schema(f"{schema}, run_id string").option("basePath", f"{root}/quarantine/{kind.rpartition('_')[2]}").parquet(*paths) \
            if paths else spark.createDataFrame([], f"{schema}, run_id string")
        return rows.join(now, ["file_path", "run_id"], "left_semi")
    return current("quarantine_files", FILES), current("quarantine_lines", LINES)
