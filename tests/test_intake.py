"""Each version of a file counts once; all outputs of a run count together or not at all."""

import os
import subprocess
import sys
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_batch import HDR, _cfg, _totals, _write

from tillroll.operators import enrich, intake, marts
from tillroll.plans import batch
from tillroll.sinks import commits, parquet, quarantine
from tillroll.sources import files, sales_csv


def _line(customer, day, cost, store=121):
    return f"{customer},{store},sugar,{day},1,50,1,{cost}"


def _run(spark, land, n, out, **kw):
    cfg = _cfg(spark, [land], f"{n:015d}", out)
    for k, v in kw.items():
        setattr(cfg, k, v)
    return batch.run(spark, cfg)


def _team(spark, out):
    rows = parquet.latest_snapshot(spark, f"{out}/sales_team_monthly_total").collect()
    return {(r.store_id, r.sales_month): float(r.total_sales) for r in rows}


def _mart(spark, out, name="sales_team_partitioned"):
    return sorted((r.run_id[-1], r.store_id, str(r.sales_date), float(r.total_cost)) for r in parquet.all_runs(spark, f"{out}/{name}").collect())


def test_a_grown_folder_adds_only_its_new_files(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 100)])
    _run(spark, land, 1, out)
    with pytest.raises(batch.NothingToProcess):
        _run(spark, land, 2, out)
    _write(f"{land}/b.csv", [HDR, _line(1, "2023-03-02", 30), _line(2, "2023-04-02", 7)])
    assert _run(spark, land, 3, out).files_ok == 1
    assert _totals(spark, out) == {(1, "2023-03"): 130.0, (2, "2023-04"): 7.0}
    assert _mart(spark, out) == [("1", 121, "2023-03-01", 100.0), ("3", 121, "2023-03-02", 30.0), ("3", 121, "2023-04-02", 7.0)]
    # March now lies where run 3 merged it; the newest run's own mart has its rows only.
    state = commits.load(spark, out)
    assert state.months["customer_month_sums"]["_month=2023-03"] == ["customer_month_sums/run_id=000000000000003/_month=2023-03"]
    assert parquet.latest_snapshot(spark, f"{out}/customer_mart").count() == 2


def test_a_changed_file_replaces_its_former_rows(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 100), _line(2, "2023-05-01", 11)])
    _write(f"{land}/b.csv", [HDR, _line(1, "2023-03-02", 30)])
    _run(spark, land, 1, out)
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 140), _line(1, "2023-04-01", 5)])
    _run(spark, land, 2, out)
    whole = os.path.join(tmp, "one")
    _run(spark, land, 1, whole)
    assert _totals(spark, out) == _totals(spark, whole) == {(1, "2023-03"): 170.0, (1, "2023-04"): 5.0}  # May is gone
    assert _team(spark, out) == _team(spark, whole)
    for name in ("customer_mart", "sales_team_mart", "sales_team_partitioned"):
        drop = lambda root: sorted(map(str, parquet.all_runs(spark, f"{root}/{name}").drop("run_id").collect()))
        assert drop(out) == drop(whole) and len(drop(out)) == 3
    # and again, now the version of run 2
    _write(f"{land}/a.csv", [HDR])
    _run(spark, land, 3, out)
    assert _totals(spark, out) == {(1, "2023-03"): 30.0}
    assert _mart(spark, out) == [("1", 121, "2023-03-02", 30.0)]
    # compaction leaves the retracted rows out for good
    assert parquet.compact_months(spark, f"{out}/sales_team_partitioned") == ["sales_month=2023-03"]
    assert [x[1:] for x in _mart(spark, out)] == [(121, "2023-03-02", 30.0)]


def test_a_bad_version_leaves_the_former_one_standing_until_it_is_repaired(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 100)])
    _run(spark, land, 1, out)
    _write(f"{land}/a.csv", ["customer_id", "1"])
    _write(f"{land}/b.csv", [HDR, _line(1, "2023-03-02", 1)])
    _run(spark, land, 2, out)
    assert _totals(spark, out) == {(1, "2023-03"): 101.0}
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 60)])
    _run(spark, land, 3, out)
    assert _totals(spark, out) == {(1, "2023-03"): 61.0}


def test_bad_files_are_kept_once_and_released_when_repaired(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/bad.csv", ["customer_id,price", "1,2", "3,4"])
    for n in (1, 2, 3):
        _write(f"{land}/good{n}.csv", [HDR, _line(1, "2023-03-01", n)])
        _run(spark, land, n, out)
    found, lines = quarantine.set_aside(spark, out)
    assert [r.file_name for r in found.collect()] == ["bad.csv"] and lines.count() == 3
    assert spark.read.parquet(f"{out}/quarantine/lines").count() == 3
    _write(f"{land}/bad.csv", ["customer_id,price,x", "1,2,3"])  # another bad version
    _write(f"{land}/good4.csv", [HDR, _line(1, "2023-03-01", 4)])
    _run(spark, land, 4, out)
    assert sorted(r.raw_line for r in quarantine.set_aside(spark, out)[1].collect()) == ["1,2,3", "customer_id,price,x"]
    _write(f"{land}/bad.csv", [HDR, _line(1, "2023-03-01", 90)])
    _run(spark, land, 5, out)
    assert [x.count() for x in quarantine.set_aside(spark, out)] == [0, 0] and _totals(spark, out) == {(1, "2023-03"): 100.0}


STEPS = [(files, "file_headers_first_bytes"), (enrich, "enrich_sales"), (quarantine, "quarantine"), (parquet, "write_snapshot"), (marts, "merge_deltas"),
         (marts, "customer_total_of_sums"), (parquet, "write_partitioned"), (intake, "outcome"), (commits, "commit")]


@pytest.mark.parametrize("step", range(len(STEPS)))
def test_a_run_that_fails_at_any_step_changes_no_output(spark, tmp, monkeypatch, step):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 100)])
    _run(spark, land, 1, out)
    names = ("customer_mart", "sales_team_mart", "sales_team_partitioned", "customer_month_sums", "sales_team_month_sums",
             "customer_monthly_total", "sales_team_monthly_total")
    see = lambda: [sorted(map(str, parquet.latest_snapshot(spark, f"{out}/{n}").collect())) for n in names]
    before = see()
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 1)])
    _write(f"{land}/b.csv", [HDR, _line(1, "2023-03-02", 50)])
    module, name = STEPS[step]

    def broken(*a, **k):
        raise RuntimeError("stop")
    with monkeypatch.context() as m:
        m.setattr(batch if step == 0 else module, name, broken)
        with pytest.raises(RuntimeError, match="stop"):
            _run(spark, land, 2, out)
    assert see() == before and _mart(spark, out) == [("1", 121, "2023-03-01", 100.0)]
    _run(spark, land, 2, out)  # done again under its id
    assert _totals(spark, out) == {(1, "2023-03"): 51.0}
    assert _mart(spark, out) == [("2", 121, "2023-03-01", 1.0), ("2", 121, "2023-03-02", 50.0)]


def test_of_two_writers_one_commits(spark, tmp):
    out = os.path.join(tmp, "out")
    base = commits.load(spark, out)
    got, wait = [], threading.Barrier(4)

    def write(n):
        wait.wait()
        try:
            got.append(commits.commit(spark, out, replace(base, run_id=str(n), runs={str(n): {}})).run_id)
        except commits.CommitConflict:
            got.append(None)
    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    (winner,) = [x for x in got if x]
    assert len(got) == 4 and commits.load(spark, out).run_id == winner
    # a record that was cut off counts as nothing, and its version is not used again
    with open(f"{out}/commits/000000000002.json", "w") as fh:
        fh.write('{"run_id": "x", "ru')
    state = commits.load(spark, out)
    assert state.run_id == winner and commits.commit(spark, out, replace(state, run_id="next")).seen == 3
    assert commits.load(spark, out).run_id == "next"


def test_a_run_beside_another_does_not_count_its_files_twice(spark, tmp, monkeypatch):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 100)])
    real = enrich.enrich_sales

    def meanwhile(*a, **k):
        monkeypatch.setattr(enrich, "enrich_sales", real)
        _run(spark, land, 2, out)  # another run takes the file in and commits
        return real(*a, **k)
    monkeypatch.setattr(enrich, "enrich_sales", meanwhile)
    with pytest.raises(commits.CommitConflict):
        _run(spark, land, 1, out)
    assert _totals(spark, out) == {(1, "2023-03"): 100.0}
    with pytest.raises(batch.NothingToProcess):
        _run(spark, land, 1, out)


def test_what_a_run_reads_does_not_grow_with_the_runs(spark, tmp, monkeypatch):
    """Lookups read a state and a short tail; sums of a month lie in one folder, others are not opened."""
    monkeypatch.setattr(intake, "COMPACT_AFTER", 2)
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    read = []
    for n in range(1, 7):
        _write(f"{land}/f{n}.csv", [HDR, _line(1, f"2023-0{1 + n % 2}-01", n)])
        _run(spark, land, n, out)
        state = commits.load(spark, out)
        assert len(state.done) <= 2 and all(len(p) == 1 for p in state.months["customer_month_sums"].values())
        read.append(len(os.listdir(f"{out}/{state.months['customer_month_sums'][f'_month=2023-0{1 + n % 2}'][0]}")))
    assert any("state-" in p for p in state.done) and max(read) <= 4
    full = spark.read.parquet(*[f"{out}/done/run_id={n:015d}" for n in range(1, 7)])
    assert intake.finished(spark, out, state).select("file_path", "run_id").exceptAll(full.select("file_path", "run_id")).isEmpty()
    assert intake.finished(spark, out, state).count() == 6
    assert _totals(spark, out) == {(1, "2023-02"): 9.0, (1, "2023-01"): 12.0}
    # the month that the last run did not touch is where an earlier one left it
    assert state.months["customer_monthly_total"]["_month=2023-02"][0].startswith("customer_monthly_total/run_id=000000000000005")


def test_runs_read_back_together_are_pruned(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    for n in (1, 2):
        _write(f"{land}/f{n}.csv", [HDR, *[_line(1, f"2023-0{m}-0{n}", 10 * m + n) for m in (3, 4)]])
        _run(spark, land, n, out)
    rows = parquet.all_runs(spark, f"{out}/sales_team_partitioned")
    some = rows.filter((F.col("sales_month") == "2023-04") & (F.col("store_id") == 121))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan and sorted(float(r.total_cost) for r in some.collect()) == [41.0, 42.0]
    assert {x.split("sales_month=")[1][:7] for x in some.inputFiles()} >= {"2023-04"}
    assert "_file_key" not in rows.columns
    assert parquet.compact_months(spark, f"{out}/sales_team_partitioned", months=["sales_month=2023-04"]) == ["sales_month=2023-04"]
    again = parquet.all_runs(spark, f"{out}/sales_team_partitioned")
    assert sorted(map(str, again.drop("run_id").collect())) == sorted(map(str, rows.drop("run_id").collect()))
    held = commits.load(spark, out).months["sales_team_partitioned"]
    assert len(held["sales_month=2023-04"]) == 1 and len(held["sales_month=2023-03"]) == 2
    _write(f"{land}/f3.csv", [HDR, _line(1, "2023-04-03", 1)])
    _run(spark, land, 3, out)
    assert parquet.all_runs(spark, f"{out}/sales_team_partitioned").count() == 5


def test_null_dates_and_runs_without_rows(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR])
    _run(spark, land, 1, out)
    assert _totals(spark, out) == {} and parquet.all_runs(spark, f"{out}/sales_team_partitioned").count() == 0
    for n in (2, 3):
        _write(f"{land}/b{n}.csv", [HDR, _line(1, "", n), _line(1, "2023-03-01", n)])
        _run(spark, land, n, out)
    assert _totals(spark, out) == {(1, None): 5.0, (1, "2023-03"): 5.0}
    assert parquet.all_runs(spark, f"{out}/sales_team_partitioned").filter("sales_month IS NULL").count() == 2


def test_a_file_without_a_line_end_is_set_aside_unread(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a.csv", [HDR, _line(1, "2023-03-01", 100)])
    _write(f"{land}/bad.csv", ["customer_id", "1"])
    with open(f"{land}/endless.csv", "wb") as fh:
        for _ in range(64):
            fh.write(b"x" * 1_000_000)
    with open(f"{land}/blank.csv", "wb") as fh:
        fh.write(b"\n \n" * 8_000_000 + HDR.encode())
    assert _run(spark, land, 1, out).files_set_aside == 3
    found, lines = quarantine.set_aside(spark, out)
    assert {r.file_name: r.reason for r in found.collect()}["endless.csv"] == "no_line_end" and lines.count() == 2
    assert {r.file_name: r.reason for r in found.collect()}["blank.csv"] == "no_line_end"
    assert _totals(spark, out) == {(1, "2023-03"): 100.0}
    # a header that ends with its file is one; the endless files stay unread in later runs
    with open(f"{land}/c.csv", "w") as fh:
        fh.write(HDR)
    assert sorted(os.path.basename(p) for p in sales_csv.endless(*batch.route(spark, land)[1:], [found.first().file_path.rpartition("/")[0]])) == ["blank.csv", "endless.csv"]
    assert _run(spark, land, 2, out).files_ok == 1


def test_earlier_files_of_a_folder_are_not_opened(spark, tmp):
    land = os.path.join(tmp, "in")
    for i in range(4):
        _write(f"{land}/f{i}.csv", [HDR, _line(1, "2023-03-01", i)])
        os.utime(f"{land}/f{i}.csv", (1_700_000_000 + 3600 * i,) * 2)
    with open(f"{land}/endless.csv", "w") as fh:
        fh.write("x" * 100)
    _, routed = batch.route(spark, land)
    some = routed.filter("file_name IN ('f2.csv', 'f3.csv')").select("file_path", "length", "modification_time")
    folder = some.first().file_path.rpartition("/")[0]
    lines = sales_csv.file_lines(spark, some, [folder], [], header=False)
    assert sorted((r.file_path[-6:], r.line) for r in lines.collect()) == [(f"f{i}.csv", _line(1, "2023-03-01", i)) for i in (2, 3)]

    def scanned(plan):
        name = plan.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "CSV" in plan.toString():
            return plan.metrics().get("numFiles").get().value()
        if name == "AdaptiveSparkPlanExec":
            return scanned(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return scanned(plan.plan())
        found = [scanned(plan.children().apply(i)) for i in range(plan.children().size())]
        return next((x for x in found if x is not None), None)
    assert scanned(lines._jdf.queryExecution().executedPlan()) == 2


def test_listing_in_rounds(spark, tmp, monkeypatch):
    land = os.path.join(tmp, "in")
    for i in range(60):
        _write(f"{land}/d{i % 7}/e{i % 3}/f{i}.csv", [HDR])
    _write(f"{land}/d1/_SUCCESS", [])
    _write(f"{land}/d1/.x.csv.crc", ["x"])
    whole = {r.file_path for r in files.file_manifest(spark, land).collect()}
    assert len(whole) == 60 and all(p.startswith("file:/") for p in whole)
    monkeypatch.setattr(files, "FOLDERS_PER_TASK", 2)
    assert {r.file_path for r in files.file_manifest(spark, land).collect()} == whole
    monkeypatch.setattr(files, "reachable", lambda paths: False)  # a store that workers can't open
    monkeypatch.setattr(files, "BLOCK", 7)
    assert sorted((r.file_path, r.length, r.modification_time) for r in files.file_manifest(spark, [land, f"{land}/d1"]).collect()) == sorted(
        (f"file:{p}", os.path.getsize(p), __import__("datetime").datetime.fromtimestamp(os.stat(p).st_mtime_ns // 1_000_000 / 1000))
        for p in [x.removeprefix("file:") for x in whole])


def test_many_files_of_three_layouts_in_one_folder(spark, tmp):
    land = os.path.join(tmp, "in")
    names = HDR.split(",")
    for i in range(300):
        row = dict(zip(names, _line(i, "2023-03-01", i).split(",")))
        cols = [names, names[::-1], [*names, "note"]][i % 3]
        row["note"] = f"n{i}"
        _write(f"{land}/f{i}.csv", [",".join(cols), ",".join(row[c] for c in cols), "not a row"])
    _, routed = batch.route(spark, land)
    whole, mixed = sales_csv.layout_folders(routed)
    assert whole == {} and len(mixed) == 1
    read = sales_csv.read_sales(spark, routed)
    assert read.layouts == 3
    got = {r.customer_id: (float(r.total_cost), r.additional_column) for r in read.accepted.collect()}
    assert got == {i: (float(i), f"n{i}" if i % 3 == 2 else None) for i in range(300)}
    assert read.rejects.filter("raw_line = 'not a row'").count() == 300


CLEAN = """
import sys, os
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
queries = E.queries()
names = [n for n in sys.argv[3:] if n in queries]
for n in names:
    print(n, queries[n](spark, "/root/testdata/sf0.001").count(), flush=True)
print("all", len(names))
"""


def run_with_clean_workers(tmp, names):
    """Python workers find pyspark but not this repository."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CLEAN, repo, f"{tmp}/shared", *names], cwd=tmp, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_queries_need_no_copy_of_the_package_on_workers(spark, tmp):
    out = run_with_clean_workers(tmp, ["file_manifest", "quarantine", "reconcile_layouts", "one_folder_layouts"])
    assert "all 4" in out
