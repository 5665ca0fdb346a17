"""Landing-folder fixtures: the star fact written as sales CSV files.

The files are written by Spark from the driver's tables, so their number
and size grow with the data. Layouts are assigned by order/line attributes
(every fact row lands in exactly one layout). Each layout folder has one
sub-folder per sales month; rows are clustered by month with a REBALANCE
hint, so a month is written by few tasks and AQE splits a hot month over
several (several files). Checks therefore count folders and rows, which
the data fixes, never files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.contracts import REQUIRED_COLUMNS
from tillroll.functions.columns import month_key
from tillroll.plans import star
from tillroll.session import fresh_dir, shuffles_go
from tillroll.sources import fs

EXTRA_COLUMNS = ("payment_mode", "channel")

# Layout name -> (column order, SQL predicate for the rows that go there).
LAYOUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "standard": (REQUIRED_COLUMNS, "l_returnflag = 'A'"),
    "extra": (REQUIRED_COLUMNS + EXTRA_COLUMNS, "l_returnflag = 'N' AND l_linestatus = 'O'"),
    "reordered": (tuple(reversed(REQUIRED_COLUMNS)), "l_returnflag = 'N' AND l_linestatus = 'F'"),
    "missing": (tuple(c for c in REQUIRED_COLUMNS if c != "store_id") + ("payment_mode",),
                "l_returnflag = 'R'"),
}
CARRY = ("l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority")


def landing_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = star.sales_fact(spark, sf_dir, carry=CARRY)
    return f.withColumn(
        "payment_mode",
        F.when(F.col("o_orderstatus") == "F", "cash").when(F.col("o_orderstatus") == "O", "UPI"),
    ).withColumn("channel", F.col("o_orderpriority"))


@contextmanager
def fact_by_layout(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The landing fact joined once and written, layout by layout and month by month; ``layout`` names a row's layout.
    What is written here is removed at the end of the ``with`` block, and the join's shuffle files before it begins."""
    layout = F.lit(None).cast("string")
    for name, (_, pred) in LAYOUTS.items():
        layout = F.when(F.expr(pred), F.lit(name)).otherwise(layout)
    used = [c for c in dict.fromkeys(c for cols, _ in LAYOUTS.values() for c in cols)]
    fact = landing_fact(spark, sf_dir).withColumn("layout", layout).where("layout IS NOT NULL").select(
        # A value that its layout doesn't write is not carried.
        *[F.when(F.col("layout").isin([n for n, (cols, _) in LAYOUTS.items() if c in cols]), F.col(c)).alias(c) for c in used], "layout")
    path = fresh_dir(spark, "landing-fact")
    month = F.year("sales_date") * 12 + F.month("sales_date")  # a number moves in fewer bytes than a text
    with shuffles_go(spark):
        (fact.withColumn("month", month).hint("rebalance", "layout", "month").drop("month")
         .write.partitionBy("layout").parquet(path))
    try:
        yield spark.read.schema(fact.schema).parquet(path)
    finally:
        fs.delete(spark, path)


def write_layout(df: DataFrame, cols: tuple[str, ...], path: str,
                 date_col: Column | None = None, clustered: bool = False) -> None:
    """``clustered``: the rows of a month lie together already."""
    out = df.select(
        *[(date_col.alias(c) if (c == "sales_date" and date_col is not None) else F.col(c))
          for c in cols],
        month_key("sales_date").alias("sales_month"),
    )
    out = out if clustered else out.hint("rebalance", "sales_month")
    (out.write.mode("error")
        .option("header", "true").partitionBy("sales_month").csv(path))


def write_landing(spark: SparkSession, sf_dir: str, root: str | None = None,
                  with_json: bool = True) -> str:
    """Write the four layouts (and a JSON export of the 'missing' rows, which
    must be routed as non-CSV) under a fresh folder; return its path."""
    root = root or fresh_dir(spark, "landing")
    with fact_by_layout(spark, sf_dir) as fact:
        for name, (cols, _) in LAYOUTS.items():
            write_layout(fact.filter(F.col("layout") == name), cols, f"{root}/{name}", clustered=True)
        if with_json:
            cols, _ = LAYOUTS["missing"]
            (fact.filter("layout = 'missing'").select(*cols, month_key("sales_date").alias("sales_month"))
             .write.mode("error").partitionBy("sales_month").option("compression", "gzip").json(f"{root}/exports"))
    return root


def write_bad_dates(spark: SparkSession, sf_dir: str, bad: str,
                    root: str | None = None) -> str:
    """Standard-layout files of the whole fact where rows matching ``bad``
    carry their date as dd/MM/yyyy (a format the contract rejects).
    ``bad`` is a SQL predicate over the fact and its carried columns."""
    root = root or fresh_dir(spark, "landing-dates")
    fact = landing_fact(spark, sf_dir)
    date_col = F.when(F.expr(bad), F.date_format("sales_date", "dd/MM/yyyy")).otherwise(
        F.col("sales_date").cast("string"))
    write_layout(fact, REQUIRED_COLUMNS, f"{root}/standard", date_col=date_col)
    return root


def write_one_folder(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """The files of all four layouts side by side in one folder, as a source without sub-folders leaves them."""
    root = root or fresh_dir(spark, "landing-one")
    with fact_by_layout(spark, sf_dir) as fact:
        for name, (cols, _) in LAYOUTS.items():
            fact.filter(F.col("layout") == name).select(*cols).write.mode("append").option("header", "true").csv(f"{root}/all")
    return root
