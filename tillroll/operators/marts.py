"""Customer and sales-team data marts, and their monthly totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.contracts import MONEY_TOTAL
from tillroll.functions.columns import cents, from_cents, full_name, month_key

# The columns of the two marts.
CUSTOMER_MART_COLUMNS = (
    "customer_id", "first_name", "last_name", "address", "pincode",
    "phone_number", "sales_date", "total_cost",
)
SALES_TEAM_MART_COLUMNS = (
    "store_id", "sales_person_id", "sales_person_first_name",
    "sales_person_last_name", "store_manager_name", "manager_id",
    "is_manager", "sales_person_address", "sales_person_pincode",
    "sales_date", "total_cost",
)


def customer_mart(enriched: DataFrame) -> DataFrame:
    """Projection of the enriched fact for the customer mart (8 columns)."""
    return enriched.select(*CUSTOMER_MART_COLUMNS)


def sales_team_mart(enriched: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Projection for the sales-team mart plus the 'yyyy-MM' sales_month (and columns to carry)."""
    return enriched.select(
        *SALES_TEAM_MART_COLUMNS, month_key("sales_date").alias("sales_month"), *carry
    )


#: Helper column of ``by_range``; a function of the first key.
RANGE = "_range"


def _with_range(sums: DataFrame, keys: tuple[str, ...]) -> tuple[str, ...]:
    return (RANGE, *keys) if RANGE in sums.columns else keys


CUSTOMER_MONTH_KEYS = ("customer_id", "full_name", "address", "phone_number", "sales_date_month")
TEAM_MONTH_KEYS = ("store_id", "sales_person_id", "full_name", "sales_month")


def _customer_months(mart: DataFrame) -> DataFrame:
    return mart.select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        month_key("sales_date").alias("sales_date_month"),
        cents("total_cost").alias("total_cents"),
    )


def customer_month_sums(mart: DataFrame) -> DataFrame:
    """Exact cents per customer, attribute variant and month."""
    return _customer_months(mart).groupBy(*CUSTOMER_MONTH_KEYS).agg(F.sum("total_cents").alias("total_cents"))


def month_delta(mart: DataFrame, keys: tuple[str, ...], sign: int = 1) -> DataFrame:
    """What rows of the customer mart (``keys``: CUSTOMER_MONTH_KEYS) or of the sales-team
    mart (TEAM_MONTH_KEYS) add to the month sums, or take away: cents and rows."""
    rows = _customer_months(mart) if keys == CUSTOMER_MONTH_KEYS else _team_months(mart)
    return rows.groupBy(*keys).agg((F.sum("total_cents") * sign).alias("total_cents"), (F.count(F.lit(1)) * sign).alias("n_rows"))


def by_range(sums: DataFrame, key: str, month: str, ranges: int) -> DataFrame:
    """Month sums moved once, so that a month's rows lie in ``ranges`` parts of whole keys, with the part's
    number (RANGE): merging, totals and writing by month then move none."""
    return sums.withColumn(RANGE, F.pmod(F.hash(key), F.lit(ranges))).repartition(month, RANGE)


def merge_deltas(deltas: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Month sums of deltas and earlier sums together; groups that lost all their rows go."""
    keys = _with_range(deltas, keys)
    return deltas.groupBy(*keys).agg(F.sum("total_cents").alias("total_cents"), F.sum("n_rows").alias("n_rows")).where("n_rows <> 0")


def customer_total_of_sums(sums: DataFrame) -> DataFrame:
    """The monthly totals of month sums (see customer_monthly_total)."""
    w = Window.partitionBy(*_with_range(sums, ("customer_id", "sales_date_month")))
    merged = sums.groupBy(*_with_range(sums, CUSTOMER_MONTH_KEYS)).agg(F.sum("total_cents").alias("total_cents"))
    return merged.select(*CUSTOMER_MONTH_KEYS, from_cents(F.sum("total_cents").over(w)).alias("total_sales"))


def customer_monthly_total(mart: DataFrame) -> DataFrame:
    """Total spend per customer and month, one row per attribute variant.

    Semantics: the month total is summed over (customer_id, month) and every
    distinct (customer_id, full_name, address, phone_number, month) row
    carries that full total -- a customer whose address varies within a month
    yields one row per variant, each with the whole month's total.

    Plan: a group-by on the five output keys first (partial aggregation
    map-side, so hot customers are reduced before the shuffle), then a window
    sum over (customer_id, month) on the reduced rows only. No window ever
    sorts raw fact rows, and no final distinct is needed because the group
    keys are already distinct. Sums run on exact integer cents (see
    ``functions.cents``).
    """
    w = Window.partitionBy("customer_id", "sales_date_month")
    return customer_month_sums(mart).select(
        *CUSTOMER_MONTH_KEYS, from_cents(F.sum("total_cents").over(w)).alias("total_sales"))


def _team_months(mart: DataFrame) -> DataFrame:
    return mart.select(
        "store_id",
        "sales_person_id",
        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
        "sales_month",
        cents("total_cost").alias("total_cents"),
    )


def sales_team_month_sums(mart: DataFrame) -> DataFrame:
    """Exact cents per store, sales person and month."""
    return _team_months(mart).groupBy(*TEAM_MONTH_KEYS).agg(F.sum("total_cents").alias("total_cents"))


def sales_team_total_of_sums(sums: DataFrame, incentive: Column | None = None) -> DataFrame:
    """The monthly totals of month sums (see sales_team_monthly_total)."""
    agg = sums.groupBy(*_with_range(sums, TEAM_MONTH_KEYS)).agg(from_cents(F.sum("total_cents")).alias("total_sales")).drop(RANGE)
    inc = incentive if incentive is not None else F.lit(None)
    return agg.withColumn("incentive", inc.cast(MONEY_TOTAL))


def sales_team_monthly_total(
    mart: DataFrame, incentive: Column | None = None
) -> DataFrame:
    """Total sales per (store, sales person, month).

    ``incentive`` is an optional caller expression over the aggregated row
    (it may refer to ``total_sales``); with none the column is null. No rate
    is assumed.
    """
    sums = sales_team_month_sums(mart)
    inc = incentive if incentive is not None else F.lit(None)
    return sums.select(*TEAM_MONTH_KEYS, from_cents("total_cents").alias("total_sales")) \
        .withColumn("incentive", inc.cast(MONEY_TOTAL))
