"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver's tables (or data Spark derives from them) in
full. Output columns are normalised for comparison: money as double, dates
as 'yyyy-MM-dd' strings, integer keys as bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import enrich, ledger, marts
from tillroll.operators.conform import fold_extras
from tillroll.contracts import (
    CUSTOMER_SCHEMA,
    PRODUCT_SCHEMA,
    SALES_TEAM_SCHEMA,
    STATUS_DONE,
    STATUS_OPEN,
    STORE_SCHEMA,
)
from tillroll.plans import batch, landing, star
from tillroll.session import app_id, fresh_dir
from tillroll.sinks import parquet
from tillroll.sinks.quarantine import quarantine, set_aside
from tillroll.sources import fs
from tillroll.sources.files import file_manifest
from tillroll.sources.sales_csv import read_dim


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _enriched(spark: SparkSession, sf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    fact = star.sales_fact(spark, sf, carry=carry, with_person=False)
    customer, store, team = star.dims(spark, sf)
    return enrich.enrich_sales(fact, customer, store, team, carry=carry, person_from_store="sales_person_id")


def q_enrich_sales(spark, sf):
    return normalise(_enriched(spark, sf))


def q_customer_mart(spark, sf):
    return normalise(marts.customer_mart(_enriched(spark, sf)))


def q_sales_team_mart(spark, sf):
    return normalise(marts.sales_team_mart(_enriched(spark, sf)))


def q_customer_monthly_total(spark, sf):
    return normalise(marts.customer_monthly_total(marts.customer_mart(_enriched(spark, sf))))


def q_customer_monthly_total_varying(spark, sf):
    e = _enriched(spark, sf, carry=("o_orderpriority",))
    e = e.withColumn("phone_number", F.col("o_orderpriority"))
    return normalise(marts.customer_monthly_total(marts.customer_mart(e)))


def q_sales_team_monthly_total(spark, sf):
    return normalise(marts.sales_team_monthly_total(marts.sales_team_mart(_enriched(spark, sf))))


# ---------------------------------------------------------------- oracle SQL

_FACT_SQL = """
fact AS (
  SELECT o.o_custkey AS customer_id, l.l_suppkey AS store_id, p.p_name AS product_name,
         CAST(l.l_shipdate AS DATE) AS sales_date, s.s_nationkey AS sales_person_id,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS price,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_cost,
         o.o_orderpriority, o.o_orderstatus, l.l_returnflag, l.l_linestatus
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

_ENRICHED_SQL = _FACT_SQL + """,
enriched AS (
  SELECT f.store_id, f.sales_date, f.sales_person_id, f.total_cost,
         c.c_custkey AS customer_id, c.c_name AS first_name, c.c_mktsegment AS last_name,
         CAST(c.c_nationkey AS VARCHAR) AS address,
         CAST(NULL AS VARCHAR) AS pincode, CAST(NULL AS VARCHAR) AS phone_number,
         st.s_name AS store_manager_name, n.n_regionkey AS manager_id,
         CASE WHEN n.n_nationkey = n.n_regionkey THEN 'Y' ELSE 'N' END AS is_manager,
         n.n_name AS sales_person_first_name, r.r_name AS sales_person_last_name,
         CAST(NULL AS VARCHAR) AS sales_person_address,
         CAST(NULL AS VARCHAR) AS sales_person_pincode,
         f.o_orderpriority
  FROM fact f
  JOIN supplier st ON st.s_suppkey = f.store_id
  JOIN customer c ON c.c_custkey = f.customer_id
  JOIN nation n ON n.n_nationkey = f.sales_person_id
  JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

SQL: dict[str, str] = {}

SQL["enrich_sales"] = "WITH " + _ENRICHED_SQL + """
SELECT CAST(store_id AS BIGINT) AS store_id, CAST(sales_date AS VARCHAR) AS sales_date,
       CAST(sales_person_id AS BIGINT) AS sales_person_id, CAST(total_cost AS DOUBLE) AS total_cost,
       CAST(customer_id AS BIGINT) AS customer_id, first_name, last_name, address, pincode,
       phone_number, store_manager_name, CAST(manager_id AS BIGINT) AS manager_id, is_manager,
       sales_person_first_name, sales_person_last_name, sales_person_address, sales_person_pincode
FROM enriched"""

SQL["customer_mart"] = "WITH " + _ENRICHED_SQL + """
SELECT CAST(customer_id AS BIGINT) AS customer_id, first_name, last_name, address, pincode,
       phone_number, CAST(sales_date AS VARCHAR) AS sales_date, CAST(total_cost AS DOUBLE) AS total_cost
FROM enriched"""

SQL["sales_team_mart"] = "WITH " + _ENRICHED_SQL + """
SELECT CAST(store_id AS BIGINT) AS store_id, CAST(sales_person_id AS BIGINT) AS sales_person_id,
       sales_person_first_name, sales_person_last_name, store_manager_name,
       CAST(manager_id AS BIGINT) AS manager_id, is_manager, sales_person_address, sales_person_pincode,
       CAST(sales_date AS VARCHAR) AS sales_date, CAST(total_cost AS DOUBLE) AS total_cost,
       strftime(sales_date, '%Y-%m') AS sales_month
FROM enriched"""

# Window sum over every row, then DISTINCT -- the defining semantics.
_MONTHLY_SQL = "WITH " + _ENRICHED_SQL + """
SELECT DISTINCT CAST(customer_id AS BIGINT) AS customer_id,
       first_name || ' ' || last_name AS full_name, address, {phone} AS phone_number,
       strftime(sales_date, '%Y-%m') AS sales_date_month,
       CAST(SUM(total_cost) OVER (PARTITION BY customer_id, strftime(sales_date, '%Y-%m')) AS DOUBLE)
         AS total_sales
FROM enriched"""
SQL["customer_monthly_total"] = _MONTHLY_SQL.format(phone="phone_number")
SQL["customer_monthly_total_varying"] = _MONTHLY_SQL.format(phone="o_orderpriority")

SQL["sales_team_monthly_total"] = "WITH " + _ENRICHED_SQL + """
SELECT CAST(store_id AS BIGINT) AS store_id, CAST(sales_person_id AS BIGINT) AS sales_person_id,
       sales_person_first_name || ' ' || sales_person_last_name AS full_name,
       strftime(sales_date, '%Y-%m') AS sales_month,
       CAST(SUM(total_cost) AS DOUBLE) AS total_sales, CAST(NULL AS DOUBLE) AS incentive
FROM enriched
GROUP BY ALL"""


# ------------------------------------------------- sinks (write, read back)

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, kind: str, make) -> str:
    """Write a derived dataset once per (application, sf, kind); reuse it while
    it exists. Each dataset lives in a fresh folder of the shared root."""
    key = (app_id(spark), sf, kind)
    path = _WRITTEN.get(key)
    if path is None or not fs.exists(spark, path):
        path = make()
        _WRITTEN[key] = path
    return path


def _partitioned_mart(spark, sf) -> str:
    def make():
        path, mart = fresh_dir(spark, "sales_team_partitioned"), marts.sales_team_mart(_enriched(spark, sf))
        parquet.write_mart(mart, stage := fresh_dir(spark, "sales_team_mart"))  # its folders are counted before it is written
        parquet.write_partitioned(spark.read.schema(mart.schema).parquet(stage), path)
        return path
    return _once(spark, sf, "partitioned", make)


def q_partitioned_mart_roundtrip(spark, sf):
    back = spark.read.parquet(_partitioned_mart(spark, sf))
    return back.groupBy(
        F.col("sales_month").cast("string").alias("sales_month"),
        F.col("store_id").cast("bigint").alias("store_id"),
    ).agg(F.count(F.lit(1)).alias("n_rows"),
          F.sum("total_cost").cast("double").alias("total_sales"))


PRUNE_MONTH = "1996-02"


def q_partition_pruned_read(spark, sf):
    back = spark.read.parquet(_partitioned_mart(spark, sf))
    return back.filter(F.col("sales_month") == PRUNE_MONTH).groupBy(
        F.col("sales_month").cast("string").alias("sales_month"),
        F.col("store_id").cast("bigint").alias("store_id"),
    ).agg(F.count(F.lit(1)).alias("n_rows"),
          F.sum("total_cost").cast("double").alias("total_sales"))


def q_snapshot_latest(spark, sf):
    def make():
        root = fresh_dir(spark, "snapshots")
        cust = marts.customer_mart(_enriched(spark, sf, carry=("l_linestatus",)))
        # First run saw only part of the files; the second saw all of them.
        parquet.write_snapshot(cust.filter(F.col("l_linestatus") == "F").drop("l_linestatus"),
                               root, "000000000000001")
        parquet.write_snapshot(marts.customer_mart(_enriched(spark, sf)), root, "000000000000002")
        return root
    root = _once(spark, sf, "snapshots", make)
    latest = parquet.latest_snapshot(spark, root)
    return latest.groupBy("run_id", F.col("customer_id").cast("bigint").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("total_cost").cast("double").alias("total_sales"))


# ------------------------------------------------------------ file front end

def _landing(spark, sf) -> str:
    return _once(spark, sf, "landing", lambda: landing.write_landing(spark, sf))


def _ingested(spark, sf, **kw) -> batch.Ingested:
    return batch.ingest(spark, _landing(spark, sf), **kw)


def _folder(path_col: str):
    """Parent folder of a file path."""
    return F.regexp_extract(F.col(path_col), r"^(.*)/[^/]*$", 1)


def q_file_manifest(spark, sf):
    m = file_manifest(spark, _landing(spark, sf))
    return m.groupBy(
        F.element_at(F.split("file_path", "/"), -3).alias("layout"), "is_csv",
    ).agg(F.countDistinct(_folder("file_path")).alias("n_folders"))


def q_header_contract(spark, sf):
    _, routed = batch.route(spark, _landing(spark, sf), header_method="text")  # counts lines
    routed = routed.filter("is_csv")
    return routed.groupBy(
        F.array_join("header", ",").alias("header"),
        F.array_join("missing", ",").alias("missing"),
        F.array_join("extra", ",").alias("extra"),
        "ok", "reason",
    ).agg(F.countDistinct(_folder("file_path")).alias("n_folders"),
          F.sum(F.col("n_lines") - 1).alias("n_rows"))


def q_reconcile_layouts(spark, sf):
    acc = _ingested(spark, sf).read.accepted
    return normalise(acc.select(*[c for c in acc.columns if not c.startswith("_")]))


def q_quarantine(spark, sf):
    ing = _ingested(spark, sf)
    files, lines = quarantine(spark, ing.routed)
    acc = ing.read.accepted.agg(
        F.countDistinct(_folder("_src_file")).alias("n_folders"),
        F.count(F.lit(1)).alias("n_rows"))
    acc = acc.select(F.lit("accepted").alias("route"), F.lit(None).cast("string").alias("reason"),
                     "n_folders", "n_rows")
    line_counts = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    q = files.join(line_counts, "file_path", "left").groupBy("reason").agg(
        F.countDistinct(_folder("file_path")).alias("n_folders"),
        F.sum(F.col("n") - 1).alias("n_rows"))
    q = q.select(F.lit("quarantined").alias("route"), "reason", "n_folders", "n_rows")
    return acc.unionByName(q)


BAD_DATE_RULE = "o_orderpriority = '1-URGENT' AND l_linestatus = 'O'"


def q_reject_rows(spark, sf):
    root = _once(spark, sf, "bad_dates",
                 lambda: landing.write_bad_dates(spark, sf, BAD_DATE_RULE))
    read = batch.ingest(spark, root).read
    acc = read.accepted.agg(F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("layout"),
                            F.lit(None).cast("string").alias("raw_line"), F.count(F.lit(1)).alias("n_rows"),
                            F.sum("total_cost").cast("double").alias("total_cost"))
    rej = read.rejects.select(F.lit("rejected").alias("outcome"),
                              F.element_at(F.split("file_path", "/"), -3).alias("layout"), "raw_line",
                              F.lit(1).cast("bigint").alias("n_rows"), F.lit(None).cast("double").alias("total_cost"))
    return acc.unionByName(rej)


def q_quarantine_written(spark, sf):
    """Every data line of the files that were set aside, written and read back."""
    def make():
        out = fresh_dir(spark, "quarantined")
        _, routed = batch.route(spark, _landing(spark, sf))
        quarantine(spark, routed, out=out, run_id="000000000000001")
        return out
    out = _once(spark, sf, "quarantined", make)
    header = ",".join(landing.LAYOUTS["missing"][0])
    return spark.read.parquet(f"{out}/lines/run_id=000000000000001").filter(F.col("raw_line") != header) \
        .select(F.element_at(F.split("file_path", "/"), -3).alias("layout"), "reason", "raw_line")


def q_fold_extras(spark, sf):
    ev = star.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") > 10, F.col("props")).alias("props"),
    )
    return fold_extras(ev, ["event_type", "props"]).select("event_id", "additional_column")


# ------------------------------------------------------- ledger, unmatched

def q_ledger_open_files(spark, sf):
    o = star.table(spark, sf, "orders")
    events = o.select(
        F.lit("r0").alias("run_id"),
        F.col("o_custkey").cast("string").alias("file_name"),
        F.col("o_custkey").cast("string").alias("file_location"),
        F.when(F.col("o_orderstatus") == "F", F.lit("I")).otherwise(F.lit("A")).alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        F.col("o_orderkey").alias("seq"),
    )
    return ledger.ledger_open_files(events)


def q_unmatched_facts(spark, sf):
    fact = star.sales_fact(spark, sf)
    customer, store, team = star.dims(spark, sf)
    customer = customer.filter(F.col("last_name") != "BUILDING")
    team = team.filter(F.col("last_name") != "AFRICA")
    miss = enrich.unmatched_facts(fact, customer, store, team)
    return normalise(miss.select("dimension", "customer_id", "store_id", "sales_person_id",
                                 "sales_date", "total_cost"))


# ------------------------------------------------------ dimension exports

def _dim_roundtrip(spark, sf, name, make_dim, schema):
    """A dimension exported as CSV by Spark, read back with its explicit
    schema (no inference; wide integer keys), as the job reads its dims."""
    def make():
        path = fresh_dir(spark, f"dim_{name}")
        make_dim(spark, sf).write.option("header", "true").csv(path)
        return path
    path = _once(spark, sf, f"dim_{name}", make)
    wide = T.StructType([T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType)
                                       else f.dataType, True) for f in schema.fields])
    return normalise(read_dim(spark, path, wide, fmt="csv"))


def q_dimension_csv_roundtrip(spark, sf):
    return _dim_roundtrip(spark, sf, "customer", star.customer_dim, CUSTOMER_SCHEMA)


def q_store_csv_roundtrip(spark, sf):
    return _dim_roundtrip(spark, sf, "store", lambda sp, d: star.store_dim(sp, d).drop("sales_person_id"), STORE_SCHEMA)


def q_sales_team_csv_roundtrip(spark, sf):
    return _dim_roundtrip(spark, sf, "sales_team", star.sales_team_dim, SALES_TEAM_SCHEMA)


def q_product_csv_roundtrip(spark, sf):
    return _dim_roundtrip(spark, sf, "product", star.product_dim, PRODUCT_SCHEMA)


# -------------------------------------------------------------------- jobs

def _run_job(spark, sf, out, run_id, folders, **kw):
    root = _landing(spark, sf)
    customer, store, team = star.dims(spark, sf)
    batch.run(spark, batch.JobConfig(
        landing=[f"{root}/{x}" for x in folders], out_root=out, run_id=run_id,
        customer=customer, store=store, sales_team=team, ledger_path=f"{out}/ledger", **kw))


def _job(spark, sf) -> str:
    def make():
        out = fresh_dir(spark, "job")
        _run_job(spark, sf, out, "000000000000001", [*landing.LAYOUTS, "exports"])
        return out
    return _once(spark, sf, "job", make)


def q_job_monthly_total(spark, sf):
    total = parquet.latest_snapshot(spark, f"{_job(spark, sf)}/customer_monthly_total")
    return normalise(total.drop("run_id"))


def q_partitioned_snapshot(spark, sf):
    """The job's (month, store) partitioned mart, read back as its newest snapshot."""
    back = parquet.latest_snapshot(spark, f"{_job(spark, sf)}/sales_team_partitioned")
    return back.groupBy(
        F.col("sales_month").cast("string").alias("sales_month"), F.col("store_id").cast("bigint").alias("store_id"),
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_cost").cast("double").alias("total_sales"))


def q_job_two_runs(spark, sf):
    """The landing files cut into two runs: the totals are those of one run over all.
    (Marts by month only; job_monthly_total writes the (month, store) folders.)"""
    def make():
        out = fresh_dir(spark, "job2")
        keys = {"partition_keys": ("sales_month",)}
        _run_job(spark, sf, out, "000000000000001", ["standard", "missing"], **keys)
        _run_job(spark, sf, out, "000000000000002", ["extra", "reordered", "exports"], **keys)
        return out
    out = _once(spark, sf, "job2", make)
    return normalise(parquet.latest_snapshot(spark, f"{out}/customer_monthly_total").drop("run_id"))


def _grown(spark, sf) -> str:
    """Three runs over a folder that grows, the earlier files and the bad ones still in it; a fourth finds nothing new.
    (Marts by month only, to spare the test disk; job_monthly_total writes the (month, store) folders.)"""
    def make():
        out = fresh_dir(spark, "job3")
        keys = {"partition_keys": ("sales_month",)}
        _run_job(spark, sf, out, "000000000000001", ["standard", "missing"], **keys)
        _run_job(spark, sf, out, "000000000000002", ["standard", "missing", "extra"], **keys)
        _run_job(spark, sf, out, "000000000000003", [""], **keys)
        try:
            _run_job(spark, sf, out, "000000000000004", [""], **keys)
        except batch.NothingToProcess:
            return out
        raise AssertionError("files were taken in twice")
    return _once(spark, sf, "job3", make)


def q_job_grown_folder(spark, sf):
    """Every file counts once, whichever run saw it first and however often it was listed."""
    return normalise(parquet.latest_snapshot(spark, f"{_grown(spark, sf)}/customer_monthly_total").drop("run_id"))


def _store_months(rows):
    return rows.groupBy(
        F.col("sales_month").cast("string").alias("sales_month"), F.col("store_id").cast("bigint").alias("store_id"),
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_cost").cast("double").alias("total_sales"))


def q_mart_over_runs(spark, sf):
    """The partitioned mart of all three runs together, pruned by month."""
    rows = parquet.all_runs(spark, f"{_grown(spark, sf)}/sales_team_partitioned")
    return _store_months(rows.filter(F.col("sales_month") == PRUNE_MONTH))


def q_mart_month_compacted(spark, sf):
    """The same after its month was rewritten as one folder."""
    def make():
        out = _grown(spark, sf)
        parquet.compact_months(spark, f"{out}/sales_team_partitioned", keys=("sales_month",), months=[f"sales_month={PRUNE_MONTH}"])
        return out
    rows = parquet.all_runs(spark, f"{_once(spark, sf, 'job3c', make)}/sales_team_partitioned")
    return _store_months(rows.filter(F.col("sales_month") == PRUNE_MONTH))


def q_set_aside_once(spark, sf):
    """Lines of files that three runs found bad: kept once."""
    _, lines = set_aside(spark, _grown(spark, sf))
    header = ",".join(landing.LAYOUTS["missing"][0])
    return lines.filter(F.col("raw_line") != header).select(F.element_at(F.split("file_path", "/"), -3).alias("layout"), "reason", "raw_line")


def q_one_folder_layouts(spark, sf):
    """Files of four layouts in one folder, accepted ones parsed in one scan."""
    root = _once(spark, sf, "landing_one", lambda: landing.write_one_folder(spark, sf))
    acc = batch.ingest(spark, root).read.accepted
    return normalise(acc.select(*[c for c in acc.columns if not c.startswith("_")]))


def q_ledger_roundtrip(spark, sf):
    """Events appended and read back: a run took in all files and finished those of
    one layout; of the files still present (not the set-aside ones) the open ones by layout."""
    layout = F.element_at(F.split("file_path", "/"), -3)

    def make():
        path = fresh_dir(spark, "ledger")
        files = file_manifest(spark, _landing(spark, sf)).filter("is_csv")
        ledger.ledger_append(ledger.ledger_events(files, "r1", STATUS_OPEN), path)
        ledger.ledger_append(ledger.ledger_events(files.filter(layout == "standard"), "r1", STATUS_DONE), path)
        return path
    events = ledger.read_ledger(spark, _once(spark, sf, "ledger", make))
    present = file_manifest(spark, _landing(spark, sf)).filter(layout != "missing")
    open_ = ledger.ledger_open_files(events, present).withColumnRenamed("file_location", "file_path")
    return open_.groupBy(layout.alias("layout")).agg(F.countDistinct(_folder("file_path")).alias("n_folders"))


_LAYOUT_SQL = "WITH " + _FACT_SQL + """,
laid AS (
  SELECT *, strftime(sales_date, '%Y-%m') AS m,
         CASE WHEN l_returnflag = 'A' THEN 'standard'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'extra'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'reordered'
              ELSE 'missing' END AS layout,
         CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'UPI' END AS payment_mode,
         o_orderpriority AS channel
  FROM fact
)"""

_PART_SQL = "WITH " + _ENRICHED_SQL + """
SELECT strftime(sales_date, '%Y-%m') AS sales_month, CAST(store_id AS BIGINT) AS store_id,
       COUNT(*) AS n_rows, CAST(SUM(total_cost) AS DOUBLE) AS total_sales
FROM enriched {where} GROUP BY ALL"""
SQL["partitioned_mart_roundtrip"] = _PART_SQL.format(where="")
SQL["partition_pruned_read"] = _PART_SQL.format(
    where=f"WHERE strftime(sales_date, '%Y-%m') = '{PRUNE_MONTH}'")

SQL["snapshot_latest"] = "WITH " + _ENRICHED_SQL + """
SELECT '000000000000002' AS run_id, CAST(customer_id AS BIGINT) AS customer_id,
       COUNT(*) AS n_rows, CAST(SUM(total_cost) AS DOUBLE) AS total_sales
FROM enriched GROUP BY ALL"""

SQL["file_manifest"] = _LAYOUT_SQL + """
SELECT layout, TRUE AS is_csv, COUNT(DISTINCT m) AS n_folders FROM laid GROUP BY layout
UNION ALL
SELECT 'exports' AS layout, FALSE AS is_csv, COUNT(DISTINCT m) AS n_folders FROM laid
WHERE layout = 'missing'"""

SQL["header_contract"] = _LAYOUT_SQL + """
SELECT h.header, h.missing, h.extra, h.ok, h.reason,
       COUNT(DISTINCT laid.m) AS n_folders, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM laid JOIN (VALUES
  ('standard', 'customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost', '', '', TRUE, NULL),
  ('extra', 'customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode,channel', '', 'payment_mode,channel', TRUE, NULL),
  ('reordered', 'total_cost,quantity,price,sales_person_id,sales_date,product_name,store_id,customer_id', '', '', TRUE, NULL),
  ('missing', 'customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode', 'store_id', 'payment_mode', FALSE, 'missing:store_id')
) AS h(layout, header, missing, extra, ok, reason) ON h.layout = laid.layout
GROUP BY ALL"""

SQL["reconcile_layouts"] = _LAYOUT_SQL + """
SELECT CAST(customer_id AS BIGINT) AS customer_id, CAST(store_id AS BIGINT) AS store_id,
       product_name, CAST(sales_date AS VARCHAR) AS sales_date,
       CAST(sales_person_id AS BIGINT) AS sales_person_id, CAST(price AS DOUBLE) AS price,
       CAST(quantity AS BIGINT) AS quantity, CAST(total_cost AS DOUBLE) AS total_cost,
       CASE WHEN layout = 'extra' THEN concat_ws(',', payment_mode, channel) END AS additional_column
FROM laid WHERE layout <> 'missing'"""

SQL["quarantine"] = _LAYOUT_SQL + """
SELECT 'accepted' AS route, CAST(NULL AS VARCHAR) AS reason,
       COUNT(DISTINCT layout || m) AS n_folders, COUNT(*) AS n_rows
FROM laid WHERE layout <> 'missing'
UNION ALL
SELECT 'quarantined', 'missing:store_id', COUNT(DISTINCT m), CAST(COUNT(*) AS BIGINT)
FROM laid WHERE layout = 'missing'
UNION ALL
SELECT 'quarantined', 'not_csv', COUNT(DISTINCT m), CAST(NULL AS BIGINT)
FROM laid WHERE layout = 'missing'"""

_LINE = """concat_ws(',', customer_id, store_id, product_name, {date}, sales_person_id, price, quantity, total_cost)"""
SQL["reject_rows"] = "WITH " + _FACT_SQL + """
SELECT 'accepted' AS outcome, CAST(NULL AS VARCHAR) AS layout, CAST(NULL AS VARCHAR) AS raw_line,
       COUNT(*) AS n_rows, CAST(SUM(total_cost) AS DOUBLE) AS total_cost
FROM fact WHERE NOT (o_orderpriority = '1-URGENT' AND l_linestatus = 'O')
UNION ALL
SELECT 'rejected', 'standard', """ + _LINE.format(date="strftime(sales_date, '%d/%m/%Y')") + """, 1, CAST(NULL AS DOUBLE)
FROM fact WHERE o_orderpriority = '1-URGENT' AND l_linestatus = 'O'"""

SQL["quarantine_written"] = _LAYOUT_SQL + """
SELECT layout, 'missing:store_id' AS reason,
       concat_ws(',', customer_id, product_name, sales_date, sales_person_id, price, quantity, total_cost, coalesce(payment_mode, '')) AS raw_line
FROM laid WHERE layout = 'missing'"""

SQL["ledger_roundtrip"] = _LAYOUT_SQL + """
SELECT layout, COUNT(DISTINCT m) AS n_folders FROM laid WHERE layout IN ('extra', 'reordered') GROUP BY layout"""

SQL["fold_extras"] = """
SELECT event_id,
       concat_ws(',', NULLIF(event_type, 'view'), CASE WHEN value > 10 THEN props END)
         AS additional_column
FROM events"""

SQL["ledger_open_files"] = """
SELECT CAST(o_custkey AS VARCHAR) AS file_location FROM (
  SELECT o_custkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) t
WHERE rn = 1 AND o_orderstatus <> 'F'"""

SQL["unmatched_facts"] = "WITH " + _FACT_SQL + """
SELECT 'customer' AS dimension, CAST(customer_id AS BIGINT) AS customer_id,
       CAST(store_id AS BIGINT) AS store_id, CAST(sales_person_id AS BIGINT) AS sales_person_id,
       CAST(sales_date AS VARCHAR) AS sales_date, CAST(total_cost AS DOUBLE) AS total_cost
FROM fact f WHERE NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_custkey = f.customer_id AND c.c_mktsegment <> 'BUILDING')
UNION ALL
SELECT 'store', CAST(customer_id AS BIGINT), CAST(store_id AS BIGINT),
       CAST(sales_person_id AS BIGINT), CAST(sales_date AS VARCHAR), CAST(total_cost AS DOUBLE)
FROM fact f WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = f.store_id)
UNION ALL
SELECT 'sales_team', CAST(customer_id AS BIGINT), CAST(store_id AS BIGINT),
       CAST(sales_person_id AS BIGINT), CAST(sales_date AS VARCHAR), CAST(total_cost AS DOUBLE)
FROM fact f WHERE NOT EXISTS (
  SELECT 1 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey = f.sales_person_id AND r.r_name <> 'AFRICA')"""

SQL["dimension_csv_roundtrip"] = """
SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
       CAST(c_nationkey AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS pincode,
       CAST(NULL AS VARCHAR) AS phone_number, CAST(NULL AS VARCHAR) AS customer_joining_date
FROM customer"""

SQL["store_csv_roundtrip"] = """
SELECT s_suppkey AS id, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS store_pincode,
       s_name AS store_manager_name, CAST(NULL AS VARCHAR) AS store_opening_date, CAST(NULL AS VARCHAR) AS reviews
FROM supplier"""

SQL["sales_team_csv_roundtrip"] = """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS first_name, r_name AS last_name, CAST(n_regionkey AS BIGINT) AS manager_id,
       CASE WHEN n_nationkey = n_regionkey THEN 'Y' ELSE 'N' END AS is_manager,
       CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS pincode, CAST(NULL AS VARCHAR) AS joining_date
FROM nation JOIN region ON n_regionkey = r_regionkey"""

SQL["product_csv_roundtrip"] = """
SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS current_price,
       CAST(NULL AS DOUBLE) AS old_price, CAST(NULL AS TIMESTAMP) AS created_date, CAST(NULL AS TIMESTAMP) AS updated_date,
       CAST(NULL AS VARCHAR) AS expiry_date
FROM part"""

# The whole job over the landing folder: rows of the 'missing' layout are
# quarantined, so the monthly total covers the other three layouts.
SQL["job_monthly_total"] = "WITH " + _ENRICHED_SQL.replace(
    "FROM fact f\n", "FROM (SELECT * FROM fact WHERE l_returnflag <> 'R') f\n"
) + """
SELECT DISTINCT CAST(customer_id AS BIGINT) AS customer_id,
       first_name || ' ' || last_name AS full_name, address, phone_number,
       strftime(sales_date, '%Y-%m') AS sales_date_month,
       CAST(SUM(total_cost) OVER (PARTITION BY customer_id, strftime(sales_date, '%Y-%m')) AS DOUBLE)
         AS total_sales
FROM enriched"""
SQL["job_two_runs"] = SQL["job_monthly_total"]

SQL["partitioned_snapshot"] = "WITH " + _ENRICHED_SQL.replace(
    "FROM fact f\n", "FROM (SELECT * FROM fact WHERE l_returnflag <> 'R') f\n"
) + """
SELECT strftime(sales_date, '%Y-%m') AS sales_month, CAST(store_id AS BIGINT) AS store_id,
       COUNT(*) AS n_rows, CAST(SUM(total_cost) AS DOUBLE) AS total_sales
FROM enriched GROUP BY ALL"""


SQL["job_grown_folder"] = SQL["job_monthly_total"]
SQL["mart_over_runs"] = "WITH " + _ENRICHED_SQL.replace(
    "FROM fact f\n", "FROM (SELECT * FROM fact WHERE l_returnflag <> 'R') f\n"
) + f"""
SELECT strftime(sales_date, '%Y-%m') AS sales_month, CAST(store_id AS BIGINT) AS store_id,
       COUNT(*) AS n_rows, CAST(SUM(total_cost) AS DOUBLE) AS total_sales
FROM enriched WHERE strftime(sales_date, '%Y-%m') = '{PRUNE_MONTH}' GROUP BY ALL"""
SQL["mart_month_compacted"] = SQL["mart_over_runs"]
SQL["set_aside_once"] = SQL["quarantine_written"]
SQL["one_folder_layouts"] = SQL["reconcile_layouts"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "enrich_sales": q_enrich_sales,
    "customer_mart": q_customer_mart,
    "sales_team_mart": q_sales_team_mart,
    "customer_monthly_total": q_customer_monthly_total,
    "customer_monthly_total_varying": q_customer_monthly_total_varying,
    "sales_team_monthly_total": q_sales_team_monthly_total,
    "partitioned_mart_roundtrip": q_partitioned_mart_roundtrip,
    "partition_pruned_read": q_partition_pruned_read,
    "header_contract": q_header_contract,
    "reconcile_layouts": q_reconcile_layouts,
    "fold_extras": q_fold_extras,
    "quarantine": q_quarantine,
    "reject_rows": q_reject_rows,
    "ledger_open_files": q_ledger_open_files,
    "unmatched_facts": q_unmatched_facts,
    "snapshot_latest": q_snapshot_latest,
    "file_manifest": q_file_manifest,
    "job_monthly_total": q_job_monthly_total,
    "dimension_csv_roundtrip": q_dimension_csv_roundtrip,
    "store_csv_roundtrip": q_store_csv_roundtrip,
    "sales_team_csv_roundtrip": q_sales_team_csv_roundtrip,
    "product_csv_roundtrip": q_product_csv_roundtrip,
    "quarantine_written": q_quarantine_written,
    "ledger_roundtrip": q_ledger_roundtrip,
    "job_two_runs": q_job_two_runs,
    "partitioned_snapshot": q_partitioned_snapshot,
    "job_grown_folder": q_job_grown_folder,
    "mart_over_runs": q_mart_over_runs,
    "mart_month_compacted": q_mart_month_compacted,
    "set_aside_once": q_set_aside_once,
    "one_folder_layouts": q_one_folder_layouts,
}
