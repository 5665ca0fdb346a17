"""Adapter from the driver's TPC-H-like tables to the sales star.

Mapping (fixed):
  fact row        lineitem joined to orders, part and supplier
  customer_id     o_custkey
  store_id        l_suppkey
  sales_person_id s_nationkey of the line's supplier
  product_name    p_name
  sales_date      to_date(l_shipdate)
  price           p_retailprice as decimal(12,2)
  quantity        l_quantity as int
  total_cost      l_extendedprice as decimal(12,2)
  customer dim    customer: first_name c_name, last_name c_mktsegment,
                  address c_nationkey as string, pincode/phone null
  store dim       supplier: id s_suppkey, store_manager_name s_name, and the
                  sales person s_nationkey for facts that carry none
  product dim     part: id p_partkey, name p_name, current_price p_retailprice
  sales-team dim  nation: first_name n_name, last_name region name,
                  manager_id n_regionkey, is_manager 'Y' iff n_nationkey = n_regionkey
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import money, null_string
from tillroll.sources import fs


#: Bytes of lineitem in a task of its join with orders, the largest: so a task's memory stays as the tables grow.
BYTES_PER_TASK = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_fact(
    spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = (), with_person: bool = True
) -> DataFrame:
    """The conformed sales fact (contract columns + additional_column).

    ``with_person=False`` leaves sales_person_id out: it comes from the
    supplier, which ``enrich_sales`` joins anyway (``person_from_store``).

    ``carry`` may name extra order/line columns to keep (e.g. o_orderpriority,
    l_returnflag, l_linestatus, o_orderstatus); they are appended after the
    contract columns. Only the columns used are read from each table.
    """
    li_cols = {"l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice"}
    o_cols = {"o_orderkey", "o_custkey"}
    li_cols |= {c for c in carry if c.startswith("l_")}
    o_cols |= {c for c in carry if c.startswith("o_")}
    # The joins move the date, not the timestamp.
    li = table(spark, sf_dir, "lineitem").select(*sorted(li_cols), F.to_date("l_shipdate").alias("sales_date"))
    o = table(spark, sf_dir, "orders").select(*sorted(o_cols))
    n = fs.size(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet") // BYTES_PER_TASK
    if n > 1:
        li, o = li.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = (
        li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        .join(p, li.l_partkey == p.p_partkey, "inner")
    )
    person = []
    if with_person:
        s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        joined = joined.join(s, li.l_suppkey == s.s_suppkey, "inner")
        person = [F.col("s_nationkey").alias("sales_person_id")]
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("p_name").alias("product_name"),
        "sales_date",
        *person,
        money("p_retailprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total_cost"),
        null_string().alias("additional_column"),
        *[F.col(c) for c in carry],
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_nationkey").cast("string").alias("address"),
        null_string().alias("pincode"),
        null_string().alias("phone_number"),
        F.lit(None).cast("date").alias("customer_joining_date"),
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        null_string().alias("address"),
        null_string().alias("store_pincode"),
        F.col("s_name").alias("store_manager_name"),
        F.col("s_nationkey").alias("sales_person_id"),
        F.lit(None).cast("date").alias("store_opening_date"),
        null_string().alias("reviews"),
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("current_price"),
        F.lit(None).cast("decimal(10,2)").alias("old_price"),
        F.lit(None).cast("timestamp").alias("created_date"),
        F.lit(None).cast("timestamp").alias("updated_date"),
        F.lit(None).cast("date").alias("expiry_date"),
    )


def sales_team_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("first_name"),
        F.col("r_name").alias("last_name"),
        F.col("n_regionkey").alias("manager_id"),
        F.when(F.col("n_nationkey") == F.col("n_regionkey"), F.lit("Y"))
        .otherwise(F.lit("N")).alias("is_manager"),
        null_string().alias("address"),
        null_string().alias("pincode"),
        F.lit(None).cast("date").alias("joining_date"),
    )


def dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(customer, store, sales_team) dimensions."""
    return customer_dim(spark, sf_dir), store_dim(spark, sf_dir), sales_team_dim(spark, sf_dir)
