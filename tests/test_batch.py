import os

import pytest
from pyspark.sql import functions as F

from tillroll.contracts import CUSTOMER_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA
from tillroll.operators import ledger
from tillroll.plans import batch
from tillroll.sinks import commits, parquet

HDR = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def _dims(spark):
    customer = spark.createDataFrame([(1, "A", "B", "x", "p", "t", None),
                                      (2, "C", "D", "y", "p", "t", None)], CUSTOMER_SCHEMA)
    store = spark.createDataFrame([(121, "a", "1", "M1", None, None)], STORE_SCHEMA)
    team = spark.createDataFrame([(1, "F", "L", 10, "N", "a", "p", None)], SALES_TEAM_SCHEMA)
    return customer, store, team


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("".join(x + "\n" for x in lines))


def _cfg(spark, paths, run_id, out):
    c, s, t = _dims(spark)
    return batch.JobConfig(landing=paths, out_root=out, run_id=run_id, customer=c, store=s,
                              sales_team=t, ledger_path=f"{out}/ledger")


def test_a_run_leaves_its_outputs_only(spark, tmp, monkeypatch, shuffle_files):
    """Parsed rows are gone before the marts are written, what a run adds to the sums before the totals; no shuffle file stays."""
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/d1.csv", [HDR, "1,121,sugar,2023-03-03,1,50,2,100", "2,121,sugar,2023-04-04,1,50,1,50"])
    seen, inner = [], batch.parquet.write_snapshot

    def write_snapshot(*args, **kw):
        seen.append(os.path.exists(f"{out}/staging/run_id={args[2]}/parsed"))
        return inner(*args, **kw)
    monkeypatch.setattr(batch.parquet, "write_snapshot", write_snapshot)
    there = shuffle_files()
    batch.run(spark, _cfg(spark, [land], "000000000000001", out))
    _write(f"{land}/d2.csv", [HDR, "1,121,sugar,2023-03-09,1,50,2,1"])
    batch.run(spark, _cfg(spark, [land], "000000000000002", out))
    assert seen == [False] * 6 and not any("run_id" in d for d, _, _ in os.walk(f"{out}/staging"))
    assert not shuffle_files(until=there) - there
    assert _totals(spark, out) == {(1, "2023-03"): 101.0, (2, "2023-04"): 50.0}
    assert parquet.compact_months(spark, f"{out}/sales_team_partitioned") == ["sales_month=2023-03"]
    assert not shuffle_files(until=there) - there
    assert parquet.all_runs(spark, f"{out}/sales_team_partitioned").count() == 3


def test_batch_run_end_to_end(spark, tmp):
    land = os.path.join(tmp, "in")
    _write(f"{land}/d1.csv", [HDR, "1,121,sugar,2023-03-03,1,50,2,100",
                              "2,121,sugar,2023-03-04,1,50,1,50",
                              "1,121,sugar,2023-04-01,1,50,1,50"])
    _write(f"{land}/bad.csv", ["customer_id,price", "1,2"])
    out = os.path.join(tmp, "out")
    res = batch.run(spark, _cfg(spark, [land], "000000000000001", out))
    assert (res.files_ok, res.files_set_aside, res.layouts) == (1, 1, 1)
    assert _totals(spark, out) == {(1, "2023-03"): 100.0, (2, "2023-03"): 50.0, (1, "2023-04"): 50.0}
    ev = ledger.read_ledger(spark, f"{out}/ledger")
    assert ledger.ledger_open_files(ev).count() == 0
    assert ev.filter(F.col("status") == "I").count() == 1
    snap = parquet.latest_snapshot(spark, f"{out}/sales_team_partitioned")
    assert snap.count() == 3
    assert {r.sales_month for r in snap.select("sales_month").distinct().collect()} == {
        "2023-03", "2023-04"}
    assert spark.read.parquet(f"{out}/quarantine/files").first().reason == \
        "missing:product_name,quantity,sales_date,sales_person_id,store_id,total_cost"
    # a committed run is not done again, under its id or another
    with pytest.raises(commits.AlreadyCommitted):
        batch.run(spark, _cfg(spark, [land], "000000000000001", out))
    with pytest.raises(batch.NothingToProcess):
        batch.run(spark, _cfg(spark, [land], "000000000000002", out))
    assert parquet.latest_snapshot(spark, f"{out}/customer_mart").count() == 3
    assert spark.read.parquet(f"{out}/quarantine/files").count() == 1
    assert spark.read.parquet(f"{out}/rejects").count() == 0


def _totals(spark, out):
    return {(r.customer_id, r.sales_date_month): float(r.total_sales)
            for r in parquet.latest_snapshot(spark, f"{out}/customer_monthly_total").collect()}


def test_totals_do_not_depend_on_how_files_are_cut_into_runs(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    days = [[HDR, f"1,121,sugar,2023-03-0{d},1,50,2,{d}00", f"2,121,sugar,2023-0{d}-01,1,50,1,7"] for d in (1, 2, 3)]
    for d, lines in enumerate(days):
        _write(f"{land}/d{d}/x.csv", lines)
    batch.run(spark, _cfg(spark, [land], "000000000000001", f"{out}/one"))
    for d in range(3):
        batch.run(spark, _cfg(spark, [f"{land}/d{d}"], f"00000000000000{d + 1}", f"{out}/three"))
    assert _totals(spark, f"{out}/one") == _totals(spark, f"{out}/three")
    assert _totals(spark, f"{out}/one")[1, "2023-03"] == 600.0
    team = parquet.latest_snapshot(spark, f"{out}/three/sales_team_monthly_total").collect()
    assert sum(float(r.total_sales) for r in team) == 621.0
    assert spark.read.parquet(f"{out}/three/customer_mart").count() == 6  # all runs kept


def test_a_run_that_failed_before_its_commit_does_not_count(spark, tmp):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/a/x.csv", [HDR, "1,121,sugar,2023-03-01,1,50,2,100"])
    _write(f"{land}/b/x.csv", [HDR, "1,121,sugar,2023-03-02,1,50,2,30"])
    broken = _cfg(spark, [f"{land}/a"], "000000000000001", out)
    broken.incentive = F.expr("raise_error('stop')")
    with pytest.raises(Exception, match="stop"):
        batch.run(spark, broken)
    batch.run(spark, _cfg(spark, [f"{land}/b"], "000000000000002", out))
    assert _totals(spark, out) == {(1, "2023-03"): 30.0}
    batch.run(spark, _cfg(spark, [f"{land}/a"], "000000000000003", out))
    assert _totals(spark, out) == {(1, "2023-03"): 130.0}


@pytest.mark.parametrize("lines", [None, ["customer_id,price", "1,2"], []])
def test_nothing_to_process_writes_nothing(spark, tmp, lines):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    _write(f"{land}/ok/x.csv", [HDR, "1,121,sugar,2023-03-01,1,50,2,100"])
    batch.run(spark, _cfg(spark, [f"{land}/ok"], "000000000000001", out))
    before = sorted(os.walk(out))
    os.makedirs(f"{land}/next")
    if lines is not None:
        _write(f"{land}/next/x.csv", lines)
    with pytest.raises(batch.NothingToProcess):
        batch.run(spark, _cfg(spark, [f"{land}/next"], "000000000000002", out))
    assert sorted(os.walk(out)) == before
    assert _totals(spark, out) == {(1, "2023-03"): 100.0}


def test_plain_overwrite_and_preview(spark, tmp):
    land = os.path.join(tmp, "in")
    _write(f"{land}/d1.csv", [HDR, "1,121,sugar,2023-03-03,1,50,2,100",
                              "1,121,sugar,2023-03-04,1,50,1,bad"])
    out = os.path.join(tmp, "out")
    cfg = _cfg(spark, [land], "000000000000009", out)
    cfg.snapshots = False
    cfg.preview_rows = 2
    cfg.parallel_writes = 1
    batch.run(spark, cfg)
    assert spark.read.parquet(f"{out}/customer_mart").count() == 1
    rej = spark.read.parquet(f"{out}/rejects/run_id=000000000000009").collect()
    assert [(r.raw_line, r.reason) for r in rej] == [
        ("1,121,sugar,2023-03-04,1,50,1,bad", "malformed_row")]
    assert _totals(spark, out) == {(1, "2023-03"): 100.0}


def test_runs_with_and_without_store_folders_read_and_compact_together(spark, tmp, monkeypatch):
    land, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    for k, most in enumerate((2_000, 1, 0), 1):
        monkeypatch.setattr(parquet, "MOST_FOLDERS", most)
        _write(f"{land}/d{k}.csv", [HDR, f"1,121,sugar,2023-03-0{k},1,50,2,{k}00", f"2,121,sugar,2023-0{k}-01,1,50,1,{k}"])
        batch.run(spark, _cfg(spark, [land], f"00000000000000{k}", out))
    root = f"{out}/sales_team_partitioned"
    depth = commits.load(spark, out).folder_keys
    assert [depth[f"sales_team_partitioned/run_id=00000000000000{k}"] for k in (1, 2, 3)] == \
        [["sales_month", "store_id"], ["sales_month"], ["sales_month"]]
    want = sorted([("2023-03", 121, 100.0 * k) for k in (1, 2, 3)] + [(f"2023-0{k}", 121, float(k)) for k in (1, 2, 3)])

    def got(rows):
        return sorted((r.sales_month, r.store_id, float(r.total_cost)) for r in rows.collect())
    assert got(parquet.all_runs(spark, root)) == want
    assert got(parquet.all_runs(spark, root).filter("sales_month = '2023-03' and store_id = 121")) == [w for w in want if w[0] == "2023-03"]
    assert parquet.compact_months(spark, root) == ["sales_month=2023-03"]
    assert got(parquet.all_runs(spark, root)) == want
    assert got(parquet.latest_snapshot(spark, root)) == [("2023-03", 121, 3.0), ("2023-03", 121, 300.0)]
