"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full into Spark's ``noop`` sink (no collect to the
driver), best of $BENCH_REPEATS runs (default 3). Sink queries write and read in
each run. Landing-folder fixtures that some
queries read are written once beforehand and reported separately under
"setup" (they are test scaffolding, not query work).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "customer_monthly_total",
    "customer_monthly_total_varying",
    "customer_mart",
    "sales_team_mart",
    "enrich_sales",
    "sales_team_monthly_total",
    "unmatched_facts",
    "ledger_open_files",
    "fold_extras",
    "header_contract",
    "reconcile_layouts",
    "quarantine",
    "reject_rows",
    "file_manifest",
    "dimension_csv_roundtrip",
    "snapshot_latest",
    "month_partitioned_write_read",
    "ledger_roundtrip",
    "reference_job",
]
# Queries that write tables and read them back: every run writes anew, so the
# time is that of both. (The (month, store) layout is not among them: with
# store = supplier it makes 83 x #suppliers folders of a few rows each, about
# 83,000 at sf0.1, and the time is that of creating files.)
WRITES = ("snapshot_latest", "dimension_csv_roundtrip", "ledger_roundtrip")


def session(cpus: str) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("tillroll-bench")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus) if cpus.isdigit() else 16)))
         .config("spark.sql.adaptive.enabled", "true")
         # Local mode: list files on the driver instead of launching a Spark
         # job per listing (the default threshold, 32 paths, suits clusters
         # with millions of files on object stores; keep it there).
         .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g")))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = session(cpus)
    if not spark.conf.get("spark.checkpoint.dir", None):  # local runs: a folder of this bench
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillroll-bench-"))

    from tillroll.operators import marts
    from tillroll.plans import catalog, landing
    from tillroll.session import fresh_dir
    from tillroll.sinks import parquet

    qs = dict(catalog.QUERIES)

    def anew(name):
        def query(sp, sf):
            for key in [k for k in catalog._WRITTEN if k[2] not in ("landing", "bad_dates")]:
                del catalog._WRITTEN[key]
            return catalog.QUERIES[name](sp, sf)
        return query

    for name in WRITES:
        qs[name] = anew(name)

    def month_partitioned_write_read(sp, sf):
        path = fresh_dir(sp, "bench-partitioned")
        parquet.write_partitioned(marts.sales_team_mart(catalog._enriched(sp, sf)), path, keys=("sales_month",))
        return sp.read.parquet(path)
    qs["month_partitioned_write_read"] = month_partitioned_write_read
    names = only or HEADLINE

    setup: dict[str, float] = {}
    setup_errors: dict[str, str] = {}

    def timed_setup(label: str, fn) -> None:
        t0 = time.time()
        try:
            fn()
            setup[label] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - the dependent queries will report too
            setup_errors[label] = f"{type(e).__name__}: {str(e)[:300]}"

    if any(n in names for n in ("header_contract", "reconcile_layouts", "quarantine",
                                "file_manifest", "ledger_roundtrip")):
        timed_setup("landing_write", lambda: catalog._landing(spark, sf_dir))
    if "reject_rows" in names:
        timed_setup("bad_dates_write", lambda: catalog._once(
            spark, sf_dir, "bad_dates",
            lambda: landing.write_bad_dates(spark, sf_dir, catalog.BAD_DATE_RULE)))
    if "reference_job" in names:
        # The source job's own workload at its own sizes (50k + 400k + 1k +
        # 200 rows in four files, 25/4/10 dimension rows): the whole batch job
        # from CSV landing files to every mart, snapshot and ledger write.
        from tillroll.plans import batch, synth

        land = fresh_dir(spark, "bench-reference-landing")
        timed_setup("reference_batch_write", lambda: synth.write_reference_batch(spark, land))
        dims = synth.synth_dims(spark)

        def reference_job(sp, _sf):
            out = fresh_dir(sp, "bench-reference-job")
            batch.run(sp, batch.JobConfig(
                landing=[land], out_root=out, run_id=batch.new_run_id(),
                customer=dims[0], store=dims[1], sales_team=dims[2],
                ledger_path=f"{out}/ledger"))
            return parquet.latest_snapshot(sp, f"{out}/customer_monthly_total")
        qs["reference_job"] = reference_job

    # JVM warm-up on a different query shape, not timed.
    qs["fold_extras"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        try:
            for _ in range(repeats):
                t = time.time()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.time() - t
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - record and go on; one line is always printed
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
        spark.catalog.clearCache()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "setup": setup,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
        **({"setup_errors": setup_errors} if setup_errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
