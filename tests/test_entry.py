"""Driver contract and oracle agreement on sf0.001 for the in-memory queries."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from tillroll.plans import catalog

FAST = ["enrich_sales", "customer_mart", "sales_team_mart", "customer_monthly_total",
        "customer_monthly_total_varying", "sales_team_monthly_total", "fold_extras",
        "ledger_open_files", "unmatched_facts", "store_csv_roundtrip", "product_csv_roundtrip",
        "sales_team_csv_roundtrip", "quarantine_written", "reject_rows", "ledger_roundtrip",
        "job_monthly_total", "job_two_runs", "partitioned_snapshot", "job_grown_folder", "mart_over_runs",
        "mart_month_compacted", "set_aside_once", "one_folder_layouts"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "full_name", "address", "phone_number",
                          "sales_date_month", "total_sales"]


def test_every_query_of_the_job_has_oracle():
    own = {q for q in E.queries() if q in catalog.QUERIES}
    assert own == set(catalog.QUERIES) and own <= set(E.oracle_sql())


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def c(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(c(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = E.queries()[name](spark, SF0001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(res.fetchall(), ocols)
