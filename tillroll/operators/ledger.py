"""Append-only file ledger: which files a run took in, and which it finished."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.contracts import LEDGER_SCHEMA, STATUS_OPEN


def ledger_events(files: DataFrame, run_id: str, status: str,
                  ts: _dt.datetime | None = None) -> DataFrame:
    """Ledger events for a set of files (column ``file_path``), one per file.

    ``seq`` orders events that share a timestamp: it is the event time in
    microseconds, so a later call always sorts after an earlier one.
    """
    ts = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    micros = int(ts.replace(tzinfo=_dt.timezone.utc).timestamp() * 1_000_000)
    return files.select(
        F.lit(run_id).alias("run_id"),
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
        F.col("file_path").alias("file_location"),
        F.lit(status).alias("status"),
        F.lit(ts).cast("timestamp").alias("event_ts"),
        F.lit(micros).cast("bigint").alias("seq"),
    )


def ledger_append(events: DataFrame, path: str) -> None:
    """Append a batch of events in one write (not one insert per file)."""
    events.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields]) \
        .write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def ledger_current(events: DataFrame, key: str = "file_location") -> DataFrame:
    """Latest event per file.

    ``max_by`` over (event_ts, seq) is an ordinary aggregate with partial
    aggregation, so a file with very many events is reduced map-side
    instead of sorted in one window partition.
    """
    latest = F.max_by(F.struct(*[c for c in events.columns]), F.struct("event_ts", "seq"))
    return events.groupBy(key).agg(latest.alias("_e")).select("_e.*")


def ledger_open_files(events: DataFrame, manifest: DataFrame | None = None,
                      key: str = "file_location") -> DataFrame:
    """Files whose latest ledger state is still open ('A'): a run took them in
    and did not finish. With a manifest (column ``file_path``), only files
    present now are reported (a left-semi join, no SQL text)."""
    open_ = ledger_current(events, key).filter(F.col("status") == STATUS_OPEN)
    if manifest is not None:
        open_ = open_.join(manifest.select(F.col("file_path").alias(key)), key, "left_semi")
    return open_.select(key).distinct()
