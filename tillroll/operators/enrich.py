"""Fact enrichment: inner joins of the sales fact to its three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output contract of enrich_sales, in order.
ENRICHED_COLUMNS = (
    "store_id", "sales_date", "sales_person_id", "total_cost",
    "customer_id", "first_name", "last_name", "address", "pincode",
    "phone_number", "store_manager_name", "manager_id", "is_manager",
    "sales_person_first_name", "sales_person_last_name",
    "sales_person_address", "sales_person_pincode",
)


def enrich_sales(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    carry: tuple[str, ...] = (),
    person_from_store: str | None = None,
) -> DataFrame:
    """Join the conformed fact to store, customer and sales-team dimensions.

    Inner equi-joins: facts whose key is null or has no match drop out (see
    ``unmatched_facts`` to surface them); duplicate dimension keys fan out.
    Join strategies are left to Spark: small dimensions are broadcast through
    the size threshold / AQE, large ones are sort-merge joined. The store key
    is joined on once: AQE splits a hot store's partition only where no other
    join in the stage relies on the same partitioning.

    ``carry`` names extra fact columns kept in the output.
    ``person_from_store`` names the store column that holds the sales person,
    for facts that do not carry one.
    """
    f = fact.alias("f")
    st = store.select(
        F.col("id").alias("st_id"), F.col("store_manager_name"),
        *([F.col(person_from_store).alias("st_person")] if person_from_store else []),
    ).alias("st")
    person = F.col("st.st_person" if person_from_store else "f.sales_person_id")
    ct = customer.select(
        F.col("customer_id").alias("ct_customer_id"),
        "first_name", "last_name", "address", "pincode", "phone_number",
    ).alias("ct")
    tm = sales_team.select(
        F.col("id").alias("tm_id"),
        "manager_id", "is_manager",
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    ).alias("tm")
    joined = (
        f.join(st, F.col("f.store_id") == F.col("st.st_id"), "inner")
        .join(ct, F.col("f.customer_id") == F.col("ct.ct_customer_id"), "inner")
        .join(tm, person == F.col("tm.tm_id"), "inner")
    )
    cols = [
        F.col("f.store_id").alias("store_id"),
        F.col("f.sales_date").alias("sales_date"),
        person.alias("sales_person_id"),
        F.col("f.total_cost").alias("total_cost"),
        F.col("ct.ct_customer_id").alias("customer_id"),
        "first_name", "last_name", "address", "pincode", "phone_number",
        "store_manager_name", "manager_id", "is_manager",
        "sales_person_first_name", "sales_person_last_name",
        "sales_person_address", "sales_person_pincode",
    ] + [F.col(f"f.{c}").alias(c) for c in carry]
    return joined.select(*cols)


def unmatched_facts(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
) -> DataFrame:
    """Fact rows that an inner join to a dimension would drop, tagged by dimension.

    One pass over the fact: it is left-joined to the *distinct* key set of
    each dimension (so duplicate dimension keys cannot fan rows out), and
    every row emits one output row per dimension it found no match in (a
    fully matched row emits none). A
    null key never matches, so it is reported as unmatched. Only the key
    column of each dimension is read; key sets are small relative to the
    fact and are broadcast or sort-merge joined by Spark's size check.
    """
    checks = [
        ("customer", "customer_id", customer.select(F.col("customer_id").alias("_k"))),
        ("store", "store_id", store.select(F.col("id").alias("_k"))),
        ("sales_team", "sales_person_id", sales_team.select(F.col("id").alias("_k"))),
    ]
    cols = fact.columns
    f = fact
    flags = []
    for i, (name, key, keys) in enumerate(checks):
        hit = f"_hit{i}"
        ks = keys.filter(F.col("_k").isNotNull()).distinct() \
            .select(F.col("_k").alias(f"_k{i}"), F.lit(True).alias(hit))
        f = f.join(ks, f[key] == ks[f"_k{i}"], "left")
        flags.append(F.when(F.col(hit).isNull(), F.lit(name)))
    return (
        f.select(*cols, F.explode(F.array_compact(F.array(*flags))).alias("dimension"))
    )
