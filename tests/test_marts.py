import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillroll.operators import marts

CM_SCHEMA = ("customer_id int, first_name string, last_name string, address string, "
             "pincode string, phone_number string, sales_date date, total_cost decimal(12,2)")


def _mart(spark, rows):
    return spark.createDataFrame(rows, CM_SCHEMA)


def test_monthly_total_varying_address_each_variant_gets_full_total(spark):
    rows = [
        (1, "A", "B", "x", None, "p", dt.date(2023, 3, 1), D("10.00")),
        (1, "A", "B", "y", None, "p", dt.date(2023, 3, 5), D("2.50")),
        (1, "A", "B", "x", None, "p", dt.date(2023, 3, 9), D("1.00")),
        (1, "A", "B", "x", None, "p", dt.date(2023, 4, 1), D("7.00")),
        (2, "C", None, "z", None, "q", dt.date(2023, 3, 1), D("4.00")),
    ]
    out = marts.customer_monthly_total(_mart(spark, rows))
    got = sorted((r.customer_id, r.full_name, r.address, r.sales_date_month, r.total_sales)
                 for r in out.collect())
    assert got == [
        (1, "A B", "x", "2023-03", D("13.50")),
        (1, "A B", "x", "2023-04", D("7.00")),
        (1, "A B", "y", "2023-03", D("13.50")),
        (2, None, "z", "2023-03", D("4.00")),  # concat with a null part is null
    ]
    assert dict((f.name, f.dataType.simpleString()) for f in out.schema.fields)["total_sales"] \
        == "decimal(18,2)"


def test_monthly_total_equals_brute_force_in_one_or_many_runs(spark):
    rows = [(i % 4, f"f{i % 3}", "l", f"a{i % 2}", None, None,
             dt.date(2023, 1 + i % 5, 1 + i % 27), D(f"{i}.{i % 100:02d}")) for i in range(300)]
    total, variants = {}, set()
    for c, first, last, address, _, phone, day, cost in rows:
        month = day.strftime("%Y-%m")
        total[c, month] = total.get((c, month), D(0)) + cost
        variants.add((c, f"{first} {last}", address, phone, month))
    want = sorted(((*v, total[v[0], v[4]]) for v in variants), key=str)
    one = marts.customer_monthly_total(_mart(spark, rows))
    parts = [marts.customer_month_sums(_mart(spark, rows[i::3])) for i in range(3)]
    many = marts.customer_total_of_sums(parts[0].union(parts[1]).union(parts[2]))
    for got in (one, many):
        assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_monthly_total_plan_has_no_window_over_raw_rows(spark):
    rows = [(1, "a", "b", "c", None, None, dt.date(2023, 1, 1), D("1.00"))]
    plan = marts.customer_monthly_total(_mart(spark, rows))._jdf.queryExecution() \
        .executedPlan().toString()
    # The window reads the output of the (final) aggregate, not the scan.
    window_at = plan.find("Window")
    agg_at = plan.find("HashAggregate")
    assert window_at != -1 and agg_at != -1 and window_at < agg_at


def test_sales_team_mart_month_and_monthly_total_incentive(spark):
    schema = ("store_id int, sales_person_id int, sales_person_first_name string, "
              "sales_person_last_name string, store_manager_name string, manager_id int, "
              "is_manager string, sales_person_address string, sales_person_pincode string, "
              "sales_date date, total_cost decimal(12,2)")
    rows = [(121, 1, "R", "S", "M", 10, "N", None, None, dt.date(2023, 3, 3), D("5.00")),
            (121, 1, "R", "S", "M", 10, "N", None, None, dt.date(2023, 3, 31), D("6.25")),
            (122, 4, "T", "U", "M2", 10, "N", None, None, dt.date(2023, 4, 1), D("1.00"))]
    enriched = spark.createDataFrame(rows, schema)
    mart = marts.sales_team_mart(enriched)
    assert mart.columns[-1] == "sales_month"
    assert sorted(r.sales_month for r in mart.collect()) == ["2023-03", "2023-03", "2023-04"]
    plain = marts.sales_team_monthly_total(mart).orderBy("store_id").collect()
    assert [(r.full_name, r.total_sales, r.incentive) for r in plain] == [
        ("R S", D("11.25"), None), ("T U", D("1.00"), None)]
    paid = marts.sales_team_monthly_total(mart, F.col("total_sales") * F.lit(0.01)) \
        .orderBy("store_id").collect()
    assert paid[0].incentive == D("0.11")


def test_customer_mart_projection(spark):
    rows = [(1, "A", "B", "x", "1", "2", dt.date(2023, 3, 1), D("10.00"))]
    enriched = _mart(spark, rows).withColumn("store_id", F.lit(1))
    assert marts.customer_mart(enriched).columns == list(marts.CUSTOMER_MART_COLUMNS)


def test_month_sums_are_moved_once_for_merge_and_total(spark):
    rows = [(i % 9, "f", "l", f"a{i % 2}", None, None, dt.date(2023, 1 + i % 3, 1), D("1.50")) for i in range(90)]
    delta = marts.month_delta(_mart(spark, rows), marts.CUSTOMER_MONTH_KEYS)
    spark.createDataFrame(delta.collect(), delta.schema).createOrReplaceTempView("deltas")
    sums = spark.table("deltas")
    merged = marts.merge_deltas(marts.by_range(sums, "customer_id", "sales_date_month", 4), marts.CUSTOMER_MONTH_KEYS)
    total = marts.customer_total_of_sums(merged)
    assert total._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = marts.customer_total_of_sums(marts.merge_deltas(sums, marts.CUSTOMER_MONTH_KEYS))
    assert sorted(total.collect(), key=str) == sorted(want.collect(), key=str) and total.count() == 18
    assert merged.groupBy("sales_date_month", marts.RANGE).count().count() > 3
