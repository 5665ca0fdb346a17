import datetime as dt

from pyspark.sql import functions as F

from tillroll.plans import synth


def test_synth_sales_rules(spark):
    df = synth.synth_sales(spark, 5000, seed=3)
    bad = df.filter(
        (F.col("total_cost") != (F.col("price") * F.col("quantity")).cast("decimal(12,2)"))
        | (F.floor((F.col("sales_person_id") - 1) / 3) != F.col("store_id") - 121)
        | ~F.col("quantity").between(1, 10)
        | ~F.col("customer_id").between(1, 20)
        | ~F.col("sales_date").between(dt.date(2023, 3, 3), dt.date(2023, 8, 20)))
    assert bad.count() == 0 and df.count() == 5000
    prices = {r.product_name: float(r.price) for r in df.select("product_name", "price").distinct().collect()}
    assert prices == {k: float(v) for k, v in synth.PRODUCTS.items()}


def test_synth_is_deterministic_across_partitionings(spark):
    a = synth.synth_sales(spark, 2000, num_partitions=1)
    b = synth.synth_sales(spark, 2000, num_partitions=7)
    assert a.exceptAll(b).count() == 0


def test_synth_layouts(spark):
    one_day = synth.synth_sales(spark, 100, dt.date(2023, 5, 1), dt.date(2023, 5, 1))
    assert one_day.select("sales_date").distinct().count() == 1
    extra = synth.synth_sales(spark, 100, layout="extra")
    assert extra.columns[-1] == "payment_mode"
    missing = synth.synth_sales(spark, 100, layout="missing")
    assert "store_id" not in missing.columns
    assert missing.filter(~F.col("sales_person_id").rlike(r"^\[\d, \d, \d\]$")).count() == 0


def test_synth_customers(spark):
    c = synth.synth_customers(spark, 25)
    rows = c.collect()
    assert [r.customer_id for r in rows] == list(range(1, 26))
    assert all(r.phone_number.startswith("91") and len(r.phone_number) == 10 for r in rows)
    assert {r.address for r in rows} == {"Delhi"}
