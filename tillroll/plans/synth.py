"""Synthetic sales and customer data as one Spark job on ``spark.range``.

Draws are hash-based (xxhash64 of row id, seed and draw number), so output
depends only on (n, seed), not on partitioning, and generation is fully
parallel at any n.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.contracts import MONEY, REQUIRED_COLUMNS

# Fixed values of the source job's sales generator: customers 1..20,
# stores 121..123 with three sales persons each (121: 1-3, 122: 4-6,
# 123: 7-9), and these products with a fixed unit price each.
PRODUCTS = {
    "quaker oats": 212,
    "sugar": 50,
    "maida": 20,
    "besan": 52,
    "refined oil": 110,
    "clinic plus": 1.5,
    "dantkanti": 100,
    "nutrella": 40,
}
FIRST_CUSTOMER, N_CUSTOMERS = 1, 20
FIRST_STORE, N_STORES = 121, 3
PERSONS_PER_STORE = 3
PAYMENT_MODES = ("cash", "UPI")
DEFAULT_START = _dt.date(2023, 3, 3)
DEFAULT_END = _dt.date(2023, 8, 20)
# Fixed values of the customer generator: one city and pincode for all,
# phone numbers are '91' followed by eight digits, joining dates in
# 2020-01-01 .. 2023-08-20.
CUSTOMER_ADDRESS = "Delhi"
CUSTOMER_PINCODE = "122009"
JOIN_START, JOIN_END = _dt.date(2020, 1, 1), _dt.date(2023, 8, 20)

# Our own name lists for synthetic customers (any names serve).
FIRST_NAMES = ("Asha", "Ravi", "Meera", "Arjun", "Kavya", "Rohan", "Isha", "Vikram",
               "Nisha", "Kabir", "Tara", "Dev")
LAST_NAMES = ("Sharma", "Verma", "Iyer", "Nair", "Gupta", "Reddy", "Das", "Mehta",
              "Kapoor", "Joshi")


def _draw(seed: int, k: int, m: int) -> Column:
    """Uniform integer in [0, m) for draw number k of each row."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(k)), F.lit(m))


def synth_sales(spark: SparkSession, n: int, start: _dt.date = DEFAULT_START,
                end: _dt.date = DEFAULT_END, seed: int = 7, layout: str = "standard",
                num_partitions: int | None = None) -> DataFrame:
    """``n`` sales rows.

    layout 'standard': the eight contract columns; 'extra': plus
    payment_mode; 'missing': no store_id, plus payment_mode, and
    sales_person_id holds a store's whole person list as text such as
    "[1, 2, 3]" (the shape the source generator emits by accident).
    Rules kept: price fixed per product, total_cost = price * quantity,
    quantity in 1..10, the sales person belongs to the row's store. Use
    start == end for a one-day file.
    """
    if layout not in ("standard", "extra", "missing"):
        raise ValueError(f"unknown layout {layout!r}")
    days = (end - start).days
    names = F.array(*[F.lit(k) for k in PRODUCTS])
    prices = F.array(*[F.lit(str(v)).cast(MONEY) for v in PRODUCTS.values()])
    base = spark.range(0, n, numPartitions=num_partitions)
    p = _draw(seed, 3, len(PRODUCTS)) + 1
    store = F.lit(FIRST_STORE) + _draw(seed, 2, N_STORES)
    person = (store - FIRST_STORE) * PERSONS_PER_STORE + 1 + _draw(seed, 5, PERSONS_PER_STORE)
    df = base.select(
        (F.lit(FIRST_CUSTOMER) + _draw(seed, 1, N_CUSTOMERS)).cast("int").alias("customer_id"),
        store.cast("int").alias("store_id"),
        F.element_at(names, p.cast("int")).alias("product_name"),
        F.date_add(F.lit(start), _draw(seed, 4, days + 1).cast("int")).alias("sales_date"),
        person.cast("int").alias("sales_person_id"),
        F.element_at(prices, p.cast("int")).alias("price"),
        (F.lit(1) + _draw(seed, 6, 10)).cast("int").alias("quantity"),
        F.element_at(F.array(*[F.lit(m) for m in PAYMENT_MODES]),
                     (_draw(seed, 7, len(PAYMENT_MODES)) + 1).cast("int")).alias("payment_mode"),
        _draw(seed, 8, N_STORES).alias("_list_store"),
    ).withColumn("total_cost", (F.col("price") * F.col("quantity")).cast(MONEY))
    if layout == "standard":
        return df.select(*REQUIRED_COLUMNS)
    if layout == "extra":
        return df.select(*REQUIRED_COLUMNS, "payment_mode")
    first = F.col("_list_store") * PERSONS_PER_STORE + 1
    as_list = F.format_string("[%d, %d, %d]", first, first + 1, first + 2)
    return df.withColumn("sales_person_id", as_list).select(
        *[c for c in REQUIRED_COLUMNS if c != "store_id"], "payment_mode")


def synth_customers(spark: SparkSession, n: int, seed: int = 11) -> DataFrame:
    """``n`` customer dimension rows with ids 1..n."""
    days = (JOIN_END - JOIN_START).days
    base = spark.range(0, n)
    digits = F.lpad(_draw(seed, 3, 100_000_000).cast("string"), 8, "0")
    return base.select(
        (F.col("id") + 1).cast("int").alias("customer_id"),
        F.element_at(F.array(*[F.lit(x) for x in FIRST_NAMES]),
                     (_draw(seed, 1, len(FIRST_NAMES)) + 1).cast("int")).alias("first_name"),
        F.element_at(F.array(*[F.lit(x) for x in LAST_NAMES]),
                     (_draw(seed, 2, len(LAST_NAMES)) + 1).cast("int")).alias("last_name"),
        F.lit(CUSTOMER_ADDRESS).alias("address"),
        F.lit(CUSTOMER_PINCODE).alias("pincode"),
        F.concat(F.lit("91"), digits).alias("phone_number"),
        F.date_add(F.lit(JOIN_START), _draw(seed, 4, days + 1).cast("int"))
        .alias("customer_joining_date"),
    )


def write_synth_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


# Row counts of the source job's four generated files (date range, one day,
# extra column, missing column).
REFERENCE_BATCH = {"sales_range": 50_000, "sales_day": 400_000,
                   "sales_extra": 1_000, "sales_missing": 200}
REFERENCE_DAY = _dt.date(2023, 8, 1)


def write_reference_batch(spark: SparkSession, root: str,
                          sizes: dict[str, int] | None = None, seed: int = 7) -> dict[str, str]:
    """Write the four kinds of sales file the source job is fed, as Spark CSV
    folders under ``root``; returns name -> folder."""
    sizes = sizes or REFERENCE_BATCH
    plan = {
        "sales_range": dict(layout="standard"),
        "sales_day": dict(layout="standard", start=REFERENCE_DAY, end=REFERENCE_DAY),
        "sales_extra": dict(layout="extra"),
        "sales_missing": dict(layout="missing", start=REFERENCE_DAY, end=REFERENCE_DAY),
    }
    out = {}
    for i, (name, kw) in enumerate(plan.items()):
        n = sizes.get(name, 0)
        if n:
            out[name] = f"{root.rstrip('/')}/{name}"
            write_synth_csv(synth_sales(spark, n, seed=seed + i, **kw), out[name])
    return out


def synth_dims(spark: SparkSession, n_customers: int = 25, n_stores: int = 4,
               n_team: int = 10, seed: int = 11) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(customer, store, sales_team) dimensions sized like the source job's
    seed tables: customers 1..n, stores 121.., sales people 1..n_team with
    person n_team as the one manager."""
    customer = synth_customers(spark, n_customers, seed)
    store = spark.range(n_stores).select(
        (F.col("id") + FIRST_STORE).cast("int").alias("id"),
        F.lit(CUSTOMER_ADDRESS).alias("address"),
        F.lit(CUSTOMER_PINCODE).alias("store_pincode"),
        F.element_at(F.array(*[F.lit(x) for x in FIRST_NAMES]),
                     (_draw(seed, 21, len(FIRST_NAMES)) + 1).cast("int")).alias("store_manager_name"),
        F.date_add(F.lit(JOIN_START), _draw(seed, 22, 365).cast("int")).alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )
    team = spark.range(n_team).select(
        (F.col("id") + 1).cast("int").alias("id"),
        F.element_at(F.array(*[F.lit(x) for x in FIRST_NAMES]),
                     (_draw(seed, 31, len(FIRST_NAMES)) + 1).cast("int")).alias("first_name"),
        F.element_at(F.array(*[F.lit(x) for x in LAST_NAMES]),
                     (_draw(seed, 32, len(LAST_NAMES)) + 1).cast("int")).alias("last_name"),
        F.lit(n_team).cast("int").alias("manager_id"),
        F.when(F.col("id") + 1 == n_team, F.lit("Y")).otherwise(F.lit("N")).alias("is_manager"),
        F.lit(CUSTOMER_ADDRESS).alias("address"),
        F.lit(CUSTOMER_PINCODE).alias("pincode"),
        F.date_add(F.lit(JOIN_START), _draw(seed, 33, 365).cast("int")).alias("joining_date"),
    )
    return customer, store, team
