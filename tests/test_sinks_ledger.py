import datetime as dt
import os

from pyspark.sql import functions as F

from tillroll.contracts import STATUS_DONE, STATUS_OPEN
from tillroll.operators import ledger
from tillroll.sinks import parquet


def _team(spark):
    rows = [(121 + i % 3, i % 9 + 1, f"2023-0{3 + i % 4}", float(i)) for i in range(60)]
    return spark.createDataFrame(rows, "store_id int, sales_person_id int, sales_month string, "
                                       "total_cost double")


def test_partitioned_write_and_pruned_read(spark, tmp):
    path = os.path.join(tmp, "p")
    df = _team(spark)
    parquet.write_partitioned(df, path)
    assert os.path.isdir(os.path.join(path, "sales_month=2023-03", "store_id=121"))
    back = spark.read.parquet(path)
    assert back.count() == 60
    assert abs(back.agg(F.sum("total_cost")).first()[0] - sum(range(60))) < 1e-9
    pruned = back.filter(F.col("sales_month") == "2023-04")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2023-04" in plan
    assert pruned.count() == 15


def test_dynamic_overwrite_replaces_only_present_partitions(spark, tmp):
    path = os.path.join(tmp, "p")
    df = _team(spark)
    parquet.write_partitioned(df, path)
    parquet.write_partitioned(df.filter("sales_month = '2023-03'").limit(1), path, dynamic=True)
    back = spark.read.parquet(path)
    # Only the one (month, store) folder the new row falls in is replaced:
    # 2023-03 had 5 rows in each of 3 stores.
    assert back.filter("sales_month = '2023-03'").count() == 1 + 10
    assert back.count() == 60 - 5 + 1


def test_snapshots_latest(spark, tmp):
    root = os.path.join(tmp, "snap")
    df = _team(spark)
    parquet.write_snapshot(df.limit(5), root, "000000000000001")
    parquet.write_snapshot(df, root, "000000000000002", partition_by=("sales_month",))
    latest = parquet.latest_snapshot(spark, root)
    assert latest.count() == 60
    assert {r.run_id for r in latest.select("run_id").distinct().collect()} == {"000000000000002"}


def test_ledger_open_files(spark, tmp):
    path = os.path.join(tmp, "ledger")
    files = spark.createDataFrame([("s3a://b/in/a.csv",), ("s3a://b/in/b.csv",),
                                   ("s3a://b/in/c.csv",)], "file_path string")
    t0 = dt.datetime(2024, 1, 1, 12)
    ledger.ledger_append(ledger.ledger_events(files, "r1", STATUS_OPEN, t0), path)
    done = files.filter(F.col("file_path") != "s3a://b/in/b.csv")
    ledger.ledger_append(ledger.ledger_events(done, "r1", STATUS_DONE,
                                              t0 + dt.timedelta(minutes=5)), path)
    ev = ledger.read_ledger(spark, path)
    assert [r.file_location for r in ledger.ledger_open_files(ev).collect()] == ["s3a://b/in/b.csv"]
    manifest = spark.createDataFrame([("s3a://b/in/a.csv",)], "file_path string")
    assert ledger.ledger_open_files(ev, manifest).count() == 0
    cur = {r.file_location: r.status for r in ledger.ledger_current(ev).collect()}
    assert cur == {"s3a://b/in/a.csv": "I", "s3a://b/in/b.csv": "A", "s3a://b/in/c.csv": "I"}


def test_read_partitioned_keeps_key_types(spark, tmp):
    path = os.path.join(tmp, "p")
    df = _team(spark).withColumn("store_id", F.col("store_id").cast("bigint"))
    parquet.write_partitioned(df, path)
    assert dict(spark.read.parquet(path).dtypes)["store_id"] == "int"  # inferred
    back = parquet.read_partitioned(spark, path, {"store_id": "bigint", "sales_month": "string"})
    assert dict(back.dtypes)["store_id"] == "bigint"
    pruned = back.filter(F.col("store_id") == 121)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and pruned.count() == 20


def test_latest_snapshot_is_the_newest_committed_run(spark, tmp):
    root = os.path.join(tmp, "run_id=7", "snap")  # the root itself may lie in a run folder
    df = _team(spark)
    parquet.write_snapshot(df, root, "000000000000001", partition_by=("sales_month",))
    # a run without rows is a snapshot too
    parquet.write_snapshot(df.limit(0), root, "000000000000002", partition_by=("sales_month",))
    empty = parquet.latest_snapshot(spark, root)
    assert empty.count() == 0 and set(empty.columns) == {*df.columns, "run_id"}
    # a run whose write was not committed is none
    parquet.write_snapshot(df.limit(3), root, "000000000000003")
    os.remove(os.path.join(root, "run_id=000000000000003", "_SUCCESS"))
    assert parquet.committed_runs(spark, root) == ["000000000000001", "000000000000002"]
    assert parquet.latest_snapshot(spark, root).count() == 0
    assert parquet.read_runs(spark, root, ["000000000000001"]).count() == 60


def test_partitioned_write_leaves_the_session_alone(spark, tmp):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    parquet.write_partitioned(_team(spark), os.path.join(tmp, "p"), dynamic=True)
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.partitionOverwriteMode")) == before


def test_folders_of_a_write_are_bounded_and_stores_lie_together(spark, tmp, monkeypatch):
    monkeypatch.setattr(parquet, "MOST_FOLDERS", 10)
    monkeypatch.setattr(parquet, "ROWS_PER_RANGE", 200)
    rows = [(i % 97 if i % 50 else None, f"2023-0{1 + i % 3}", float(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "store_id int, sales_month string, total_cost double")
    path = os.path.join(tmp, "p")
    parquet.write_partitioned(df, path)
    folders = [d for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)]
    assert len(folders) == 3
    back = spark.read.parquet(path)
    assert sorted(back.select(*df.columns).collect(), key=str) == sorted(df.collect(), key=str)
    files = back.groupBy("sales_month", "store_id").agg(F.count_distinct("_metadata.file_name").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1
    # Each file's rows are ordered by store: row groups know their stores.
    for d in folders:
        for f in os.listdir(d):
            if f.endswith(".parquet"):
                stores = [-1 if r[0] is None else r[0] for r in spark.read.parquet(os.path.join(d, f)).select("store_id").collect()]
                assert stores == sorted(stores)
