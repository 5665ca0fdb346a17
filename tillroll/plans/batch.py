"""The batch job: landing files -> checked, conformed fact -> marts -> sinks.

    paths -> file_manifest -> new files only -> file_headers -> route_files -+- bad  -> quarantine
                                                           +- good, per layout
    -> read_sales (explicit schema, staged as Parquet) -+- malformed -> rejects
                                                        +- conformed fact
    -> enrich_sales (joined once, staged as Parquet)
    -> customer mart | sales-team mart | partitioned mart   (versioned by run_id)
    -> month sums merged with those of earlier runs -> monthly totals, touched months only
    -> commit record of all outputs -> ledger 'I' (+ JDBC)

Only layouts, folders and names of months reach the driver; all row work is
Spark jobs.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.contracts import SOURCE_FILE_COLUMN, STATUS_DONE, STATUS_OPEN
from tillroll.operators import enrich, intake, ledger, marts
from tillroll.operators.contract import route_files
from tillroll.sinks import commits, parquet, quarantine as qmod
from tillroll.sinks.jdbc import write_jdbc
from tillroll.session import fresh_dir, shuffles_go
from tillroll.sources.files import (
    file_headers,
    file_headers_first_bytes,
    file_manifest,
    literal_paths,
    reachable,
)
from tillroll.sources import fs
from tillroll.sources.fs import glob_names
from tillroll.sources.sales_csv import SalesRead, folder_of, read_sales, reject_rows

log = logging.getLogger("tillroll")

CSV_GLOB = "*.csv"
#: Partition column of the month sums and totals: a copy of their month.
MONTH_FOLDER = "_month"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Month sums, about, that one task merges.
SUMS_PER_RANGE = 500_000


class NothingToProcess(RuntimeError):
    """No file of the landing folders can be taken in."""


@dataclass
class Ingested:
    manifest: DataFrame
    routed: DataFrame
    read: SalesRead


def route(spark: SparkSession, paths: str | list[str], header_method: str = "auto",
          done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest, routed files) of landing folders, each listed and checked once.

    With ``done`` (see operators.intake), files that are done with as they are
    have ``known`` in the first table and no row in the second, and their headers are not read.

    ``header_method`` "first_bytes" reads only the first bytes of each file in
    Spark tasks through Arrow (O(files); workers need direct storage access);
    "text" reads headers with one Spark text scan (any store; counts lines
    too, but reads all bytes of the folders with such files); "auto" takes "first_bytes" where the store is
    one that Arrow opens by itself, else "text". Both tables are one short row
    per file and are written once to the shared folder.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if header_method == "auto":
        header_method = "first_bytes" if reachable(paths) else "text"
    manifest = file_manifest(spark, paths)
    if done is None:
        new = manifest = _written(manifest, "manifest")
    else:
        manifest = _written(intake.with_known(manifest, done), "manifest")
        new = manifest.filter("known IS NULL").drop("known")
    if header_method == "first_bytes":
        headers = file_headers_first_bytes(new)
    elif header_method == "text":
        if done is not None:
            paths = [r[0] for r in new.filter("is_csv").select(folder_of("file_path")).distinct().collect()]
            paths = [p for p in paths if not any(p.startswith(q + "/") for q in paths)]
        headers = file_headers(spark, literal_paths(paths), path_glob=CSV_GLOB, recursive=True) if paths else \
            spark.createDataFrame([], "file_path string, header_line string, n_lines bigint")
    else:
        raise ValueError(f"unknown header_method {header_method!r}")
    return manifest, _written(route_files(new, headers), "routed")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest(spark: SparkSession, paths: str | list[str], header_method: str = "auto",
           stage: str | None = None) -> Ingested:
    """List, check and read landing folders; ``stage``: where the parsed rows are written (see read_sales)."""
    manifest, routed = route(spark, paths, header_method)
    return Ingested(manifest, routed, read_sales(spark, routed, stage))


@dataclass
class JobConfig:
    landing: list[str]
    out_root: str
    run_id: str
    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame
    ledger_path: str | None = None
    partition_keys: tuple[str, ...] = ("sales_month", "store_id")
    # True: marts are versioned under <mart>/run_id=<id>/ (read the current
    # one with sinks.parquet.latest_snapshot); False: plain overwrite.
    snapshots: bool = True
    jdbc_url: str | None = None
    jdbc_table: str = "customers_data_mart"
    jdbc_properties: dict = field(default_factory=dict)
    incentive: Column | None = None
    # Debug: log the schema and this many rows of the enriched fact and the
    # marts (each preview is an extra Spark job, so 0 = off).
    preview_rows: int = 0
    # How headers are found; see route().
    header_method: str = "auto"
    # Number of output writes submitted at once (1 = one after another).
    parallel_writes: int = 4


@dataclass
class JobResult:
    run_id: str
    files_ok: int
    files_set_aside: int
    layouts: int
    outputs: dict[str, str]
    timings: dict[str, float] = field(default_factory=dict)


class _Clock:
    """Wall time per job step, logged and returned with the result."""

    def __init__(self) -> None:
        self.t = time.time()
        self.steps: dict[str, float] = {}

    def lap(self, step: str) -> None:
        now = time.time()
        self.steps[step] = round(now - self.t, 3)
        log.info("%s: %.2fs", step, now - self.t)
        self.t = now


def run(spark: SparkSession, cfg: JobConfig) -> JobResult:
    """Run one batch over the files that no run has done with yet.

    Raises NothingToProcess, before anything is written to the outputs, when
    no new file is accepted, and AlreadyCommitted for a run id that has a commit. A
    file that changed since a run took it in is taken in anew, and its former
    rows are retracted. All outputs are written under the run's own folders and
    count from the moment the commit record names them, all together; a run that
    fails before can be done again with the same id. The sums and totals of
    months that the run touches are merged with what there is of these months;
    others are not read. CommitConflict is raised when another run committed
    meanwhile (its files may be the same): run again.

    After the commit come the ledger's 'I' events (a log; intake does not
    depend on it) and, with ``jdbc_url``, ``publish``, which can be repeated.

    What is staged goes as soon as it has been read for the last time, and each
    query's shuffle files when it ends, so that a run holds its outputs and
    what its running queries need.
    """
    with shuffles_go(spark):
        return _run(spark, cfg)


def _run(spark: SparkSession, cfg: JobConfig) -> JobResult:
    out = cfg.out_root.rstrip("/")
    clock = _Clock()
    state = commits.load(spark, out)
    if cfg.run_id in state.runs:
        raise commits.AlreadyCommitted(cfg.run_id)
    done = intake.finished(spark, out, state)
    manifest, routed = route(spark, cfg.landing, cfg.header_method, done if state.done else None)
    counts = {r["ok"]: r["count"] for r in routed.groupBy("ok").count().collect()}
    clock.lap("list_headers_route")
    if not counts.get(True):
        raise NothingToProcess(f"no accepted file among {sum(counts.values())} new ones")
    listed = manifest if state.done else None
    seq = state.seen + 1
    mine = f"run_id={cfg.run_id}"

    def open_ledger() -> None:
        _warn_of_open(spark, out, state, routed)
        routed.filter("ok").select("file_path").write.mode("overwrite").parquet(f"{out}/open/{mine}")
        if cfg.ledger_path:
            ledger.ledger_append(
                ledger.ledger_events(routed.filter("ok").select("file_path"), cfg.run_id, STATUS_OPEN),
                cfg.ledger_path)

    def set_aside() -> None:
        qmod.quarantine(spark, routed, out=f"{out}/quarantine", run_id=cfg.run_id, listed=listed)

    # The ledger 'A' events and the quarantine do not depend on parsing: run
    # them beside it (both finish before any mart is written).
    side = ThreadPoolExecutor(max_workers=2) if cfg.parallel_writes > 1 else None
    pending = [side.submit(open_ledger), side.submit(set_aside)] if side else []
    try:
        if not side:
            open_ledger()
            set_aside()
        staging = f"{out}/staging/{mine}"
        read = read_sales(spark, routed, f"{staging}/parsed", listed)
        reject_rows(read.parsed).write.mode("overwrite").parquet(f"{out}/rejects/{mine}")
        clock.lap("parse_rejects")
        # Joined once and written: every mart reads that table, so large
        # dimensions are shuffled once per run, not once per output.
        fact = read.parsed.filter(F.col("_corrupt_record").isNull())
        joined = enrich.enrich_sales(fact, cfg.customer, cfg.store, cfg.sales_team, carry=(SOURCE_FILE_COLUMN,))
        joined.write.mode("overwrite").parquet(f"{out}/fact/{mine}")
        enriched = spark.read.schema(joined.schema).parquet(f"{out}/fact/{mine}")
        fs.delete(spark, f"{staging}/parsed")
        clock.lap("join_stage")
        for f in pending:
            f.result()
        clock.lap("ledger_open_quarantine_wait")
    finally:
        if side:
            side.shutdown(wait=True)
    key = intake.file_key(SOURCE_FILE_COLUMN, F.lit(cfg.run_id)).alias(intake.FILE_KEY)
    cust, team = marts.customer_mart(enriched), marts.sales_team_mart(enriched)
    if cfg.preview_rows:
        for label, df in (("enriched", enriched), ("customer_mart", cust),
                          ("sales_team_mart", team)):
            preview(df, label, cfg.preview_rows)
    outputs = {name: f"{out}/{name}" for name in (
        "customer_mart", "sales_team_mart", "sales_team_partitioned",
        "customer_month_sums", "sales_team_month_sums",
        "customer_monthly_total", "sales_team_monthly_total")}
    folders = {"fact": f"fact/{mine}", "rejects": f"rejects/{mine}", "quarantine_files": f"quarantine/files/{mine}", "quarantine_lines": f"quarantine/lines/{mine}"}
    schemas, months, folder_keys = dict(state.schemas), dict(state.months), dict(state.folder_keys)

    # Former versions of the files taken in: what they added goes.
    retracted, gone = list(state.retracted), None
    if state.done:
        old = _written(intake.superseded(routed, done), "superseded")
        runs = sorted(r[0] for r in old.select("rows_run").distinct().collect())
        if runs:
            if intake.key_clash(old, done):
                raise RuntimeError("two files share a key; give the run another id")
            old.select(intake.FILE_KEY).write.mode("overwrite").parquet(f"{out}/retracted/{mine}")
            retracted.append(f"retracted/{mine}")
            held = spark.read.schema(T.StructType([*enriched.schema.fields, T.StructField("run_id", T.StringType())])) \
                .option("basePath", f"{out}/fact").parquet(*[f"{out}/{state.runs[r]['fact']}" for r in runs])
            gone = held.join(old.select(F.col("file_path").alias(SOURCE_FILE_COLUMN), F.col("rows_run").alias("run_id")),
                             [SOURCE_FILE_COLUMN, "run_id"], "left_semi")

    def snapshot(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
        rows = df.select(*[c for c in df.columns if c != SOURCE_FILE_COLUMN], key)
        path = parquet.write_snapshot(rows, outputs[name], cfg.run_id, partition_by=partition_by)
        folders[name] = f"{name}/{mine}"
        order = [c for c in rows.columns if c not in partition_by] + list(partition_by)
        schemas[name] = rows.select(*order).schema.json()
        if partition_by:
            held = {m: list(p) for m, p in months.get(name, {}).items()}
            for m in glob_names(spark, path, f"{partition_by[0]}=*"):
                held.setdefault(m, []).append(f"{name}/{mine}/{m}")
            months[name] = held
            folder_keys[f"{name}/{mine}"] = parquet.folder_keys(spark, path, partition_by)

    def months_of(name: str, total: str, mart_of, keys: tuple[str, ...], month: str, to_total) -> None:
        """Merge what this run adds into the months it touches, and make their totals anew."""
        delta = marts.month_delta(mart_of(enriched), keys)
        if gone is not None:
            delta = delta.unionByName(marts.month_delta(mart_of(gone), keys, -1))
        delta.write.mode("overwrite").parquet(f"{staging}/{name}")
        delta = spark.read.schema(delta.schema).parquet(f"{staging}/{name}")
        sizes = {r[0]: r[1] for r in delta.groupBy(month).count().collect()}
        touched = {f"{MONTH_FOLDER}={m or NULL_FOLDER}" for m in sizes}
        held = [f"{out}/{p}" for m in sorted(touched) for p in months.get(name, {}).get(m, ())]
        rows = delta
        if held:
            before = spark.read.schema(delta.schema).parquet(*held)
            rows = delta.unionByName(before)
            for m, n in before.groupBy(month).count().collect():
                sizes[m] = sizes.get(m, 0) + n
        ranges = -(-max(sizes.values(), default=1) // SUMS_PER_RANGE)

        def by_month(df: DataFrame, output: str) -> DataFrame:
            df = df.drop(marts.RANGE)
            parquet.write_partitioned(df.withColumn(MONTH_FOLDER, F.col(month)), f"{outputs[output]}/{mine}", keys=(MONTH_FOLDER,), clustered=True)
            there = glob_names(spark, f"{outputs[output]}/{mine}", f"{MONTH_FOLDER}=*")
            kept = {m: p for m, p in months.get(output, {}).items() if m not in touched}
            months[output] = kept | {m: [f"{output}/{mine}/{m}"] for m in there}
            schemas[output] = df.schema.json()
            paths = [f"{outputs[output]}/{mine}/{m}" for m in there]
            return spark.read.schema(df.schema).parquet(*paths) if paths else spark.createDataFrame([], df.schema)
        sums = by_month(marts.merge_deltas(marts.by_range(rows, keys[0], month, ranges), keys), name)
        fs.delete(spark, f"{staging}/{name}")
        by_month(to_total(marts.by_range(sums, keys[0], month, ranges)), total)

    writes = [
        lambda: months_of("customer_month_sums", "customer_monthly_total", marts.customer_mart, marts.CUSTOMER_MONTH_KEYS, "sales_date_month",
                          marts.customer_total_of_sums),
        lambda: months_of("sales_team_month_sums", "sales_team_monthly_total", marts.sales_team_mart, marts.TEAM_MONTH_KEYS, "sales_month",
                          lambda sums: marts.sales_team_total_of_sums(sums, cfg.incentive)),
    ]
    if cfg.snapshots:
        # Each mart is written once, straight to its versioned folder
        # <mart>/run_id=<id>/; the newest mart is latest_snapshot(<mart>).
        cust_rows, team_rows = enriched.select(*cust.columns, SOURCE_FILE_COLUMN), marts.sales_team_mart(enriched, carry=(SOURCE_FILE_COLUMN,))
        writes += [
            lambda: snapshot(cust_rows, "customer_mart"),
            lambda: snapshot(team_rows, "sales_team_mart"),
            lambda: snapshot(team_rows, "sales_team_partitioned", cfg.partition_keys),
        ]
    else:
        writes += [
            lambda: parquet.write_mart(cust, outputs["customer_mart"]),
            lambda: parquet.write_mart(team, outputs["sales_team_mart"]),
            lambda: parquet.write_partitioned(team, outputs["sales_team_partitioned"],
                                              cfg.partition_keys),
        ]
    # The outputs are independent jobs over the staged table: submit them
    # together so the scheduler can fill the cluster (Spark runs jobs from
    # several driver threads concurrently). Any failure is re-raised.
    _run_all(writes, cfg.parallel_writes)
    fs.delete(spark, staging)
    clock.lap("marts_totals")
    tables = [*state.done, f"done/{mine}"]
    intake.outcome(routed, done, cfg.run_id, seq).write.mode("overwrite").parquet(f"{out}/{tables[-1]}")
    new = replace(state, run_id=cfg.run_id, runs={**state.runs, cfg.run_id: folders}, months=months, schemas=schemas,
                  done=tables, retracted=retracted, folder_keys=folder_keys)
    if len(tables) > intake.COMPACT_AFTER:
        intake.finished(spark, out, new).write.mode("overwrite").parquet(f"{out}/done/state-{seq:012d}")
        new = replace(new, done=[f"done/state-{seq:012d}"])
    commits.commit(spark, out, new)
    clock.lap("commit")
    if cfg.ledger_path:
        ledger.ledger_append(
            ledger.ledger_events(routed.filter("ok").select("file_path"), cfg.run_id, STATUS_DONE),
            cfg.ledger_path)
    if cfg.jdbc_url:
        publish(spark, cfg)
        clock.lap("jdbc")
    return JobResult(cfg.run_id, counts.get(True, 0), counts.get(False, 0), read.layouts, outputs,
                     clock.steps)


def publish(spark: SparkSession, cfg: JobConfig) -> None:
    """Append the committed customer totals, with their run_id, to the JDBC table. Readers
    take the newest run's rows, so doing it again after a failure is harmless."""
    written = parquet.latest_snapshot(spark, f"{cfg.out_root.rstrip('/')}/customer_monthly_total")
    write_jdbc(written, cfg.jdbc_url, cfg.jdbc_table, cfg.jdbc_properties)


def _warn_of_open(spark: SparkSession, out: str, state: commits.State, routed: DataFrame) -> None:
    """Log the files of this run that an earlier one took in and did not commit. Only the folders of such runs are read."""
    left = [n for n in glob_names(spark, f"{out}/open", "run_id=*/_SUCCESS") if n.partition("=")[2] not in state.runs]
    if left:
        names = spark.read.schema("file_path string").parquet(*[f"{out}/open/{n}" for n in left])
        stale = routed.filter("ok").join(names, "file_path", "left_semi").count()
        if stale:
            log.warning("%d files were left open by %d earlier runs", stale, len(left))


def _run_all(tasks: list, workers: int) -> None:
    if workers <= 1:
        for t in tasks:
            t()
        return
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def preview(df: DataFrame, label: str, n: int = 20) -> None:
    """Log a frame's schema and its first ``n`` rows (debug aid)."""
    log.info("%s schema: %s", label, df.schema.simpleString())
    for row in df.limit(n).collect():
        log.info("%s row: %s", label, row)


def new_run_id(now: _dt.datetime | None = None) -> str:
    """Zero-padded epoch milliseconds: sorts in run order as a string."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{int(now.timestamp() * 1000):015d}"
