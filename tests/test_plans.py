"""Plan shape: pruning and pushdown reach the scans; no file passes -> empty fact."""

import contextlib
import io
import os
import re

from conftest import SF0001
from pyspark.sql import functions as F

from tillroll.contracts import SALES_SCHEMA
from tillroll.plans import batch, catalog, landing, star


def test_star_scans_are_pruned_and_filtered(spark):
    df = catalog.q_customer_monthly_total(spark, SF0001)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    li = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema: struct<l_")][0]
    assert "l_discount" not in li and "l_tax" not in li and "l_returnflag" not in li
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plan


def test_no_good_file_gives_empty_typed_fact(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    with open(os.path.join(d, "x.csv"), "w") as fh:
        fh.write("customer_id,price\n1,2\n")
    ing = batch.ingest(spark, d)
    assert ing.read.layouts == 0
    acc = ing.read.accepted
    assert acc.count() == 0
    assert acc.columns[:9] == SALES_SCHEMA.names


def test_tasks_of_the_order_join_grow_in_number_with_lineitem(spark, monkeypatch):
    monkeypatch.setattr(star, "BYTES_PER_TASK", 5_000)
    n = os.path.getsize(f"{SF0001}/lineitem.parquet") // 5_000
    assert n > 20
    plan = star.sales_fact(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"hashpartitioning\([lo]_orderkey#\d+L?, {n}\)", plan)) == 2, plan


def test_landing_fact_is_joined_once_for_all_layouts(spark, tmp, monkeypatch):
    """Lines of the CSV files and of the JSON export carry the values of one evaluation."""
    once = landing.landing_fact
    monkeypatch.setattr(landing, "landing_fact", lambda s, d: once(s, d).withColumn("product_name", F.expr("uuid()")))
    root = landing.write_landing(spark, SF0001, os.path.join(tmp, "in"))
    csv = spark.read.option("header", "true").csv(f"{root}/missing").select("product_name")
    exported = spark.read.json(f"{root}/exports").select("product_name")
    assert csv.count() > 100 and csv.exceptAll(exported).count() == exported.exceptAll(csv).count() == 0
    months = len(os.listdir(f"{root}/missing"))
    assert sum(len([f for f in fs if f.endswith(".csv")]) for _, _, fs in os.walk(f"{root}/missing")) < 3 * months


def test_the_landing_files_are_all_that_stays(spark, tmp, monkeypatch, shuffle_files):
    """The joined fact and the shuffle files of the joins go once the files are written; the export is compressed."""
    monkeypatch.setattr(landing, "fresh_dir", lambda s, name: os.path.join(tmp, name))
    there = shuffle_files()
    root = landing.write_landing(spark, SF0001)
    assert os.listdir(tmp) == ["landing"] and not shuffle_files(until=there) - there
    names = [f for _, _, fs in os.walk(f"{root}/exports") for f in fs if f.startswith("part-")]
    assert names and all(f.endswith(".json.gz") for f in names)
    landing.write_one_folder(spark, SF0001)
    assert sorted(os.listdir(tmp)) == ["landing", "landing-one"]
