"""A customer holding a third of all facts: the join is split, nothing dropped."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillroll.operators import marts
from tillroll.operators.enrich import enrich_sales

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_customer_join_is_split_and_complete(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        ids = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500 + 1000)
            .cast("bigint").alias("customer_id"),
            F.lit(121).cast("bigint").alias("store_id"),
            F.lit("sugar").alias("product_name"),
            F.lit(dt.date(2023, 3, 3)).alias("sales_date"),
            F.lit(1).cast("bigint").alias("sales_person_id"),
            F.lit(D("50.00")).cast("decimal(12,2)").alias("price"),
            F.lit(1).alias("quantity"),
            # distinct amounts: AQE measures skew in compressed shuffle bytes
            (F.col("id") % 100_000 / 100).cast("decimal(12,2)").alias("total_cost"),
            F.lit(None).cast("string").alias("additional_column"),
        )
        fact = ids
        customer = spark.range(1500).select(
            F.col("id").cast("bigint").alias("customer_id"), F.lit("A").alias("first_name"),
            F.lit("B").alias("last_name"), F.lit("x").alias("address"),
            F.lit(None).cast("string").alias("pincode"), F.lit(None).cast("string").alias("phone_number"))
        store = spark.createDataFrame([(121, "M")], "id bigint, store_manager_name string")
        team = spark.createDataFrame([(1, 10, "N", "F", "L", None, None)],
                                     "id bigint, manager_id int, is_manager string, first_name string, "
                                     "last_name string, address string, pincode string")
        out = enrich_sales(fact, customer, store, team)
        rows = out.collect()
        assert len(rows) == n  # no row dropped or sampled
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "skew=true" in final
        hot = marts.customer_monthly_total(marts.customer_mart(out)).filter("customer_id = 7").first()
        expect = sum(D(i % 100_000) / 100 for i in range(0, n, 3))
        assert hot.total_sales == expect
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_partition_folder_is_split_across_tasks(spark, tmp):
    import os

    from tillroll.sinks import parquet

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.adaptive.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(121)).otherwise(F.col("id") % 50 + 200)
            .cast("int").alias("store_id"),
            F.lit("2023-03").alias("sales_month"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        path = os.path.join(tmp, "p")
        parquet.write_partitioned(df, path)
        hot = os.path.join(path, "sales_month=2023-03", "store_id=121")
        files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
        assert len(files) > 1  # the hot folder was written by several tasks
        assert spark.read.parquet(path).count() == n
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_store_join_is_split_on_the_registered_star_path(spark, tmp):
    """Store 7 holds a third of the lines: the one join on the store key is the one that is split."""
    import os
    import re

    from conftest import SF0001
    from tillroll.plans import catalog

    sf = os.path.join(tmp, "sf")
    for t in ("orders", "part", "supplier", "customer", "nation", "region"):
        spark.read.parquet(f"{SF0001}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    lines = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_suppkey")).cast(lines.schema["l_suppkey"].dataType)
    lines.withColumn("l_suppkey", hot).write.parquet(f"{sf}/lineitem.parquet")
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        out = catalog.QUERIES["enrich_sales"](spark, sf)
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
        store = [x for x in re.findall(r"SortMergeJoin(?:\(skew=true\))? \[[^\n]*", final) if "suppkey" in x or "store_id" in x]
        assert len(store) == 1 and "skew=true" in store[0], store
        assert n == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
