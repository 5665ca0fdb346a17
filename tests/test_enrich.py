import datetime as dt
from decimal import Decimal as D

from tillroll.contracts import CUSTOMER_SCHEMA, SALES_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA
from tillroll.operators.enrich import ENRICHED_COLUMNS, enrich_sales, unmatched_facts


def _frames(spark, customers):
    day = dt.date(2023, 3, 3)
    fact = spark.createDataFrame([
        (1, 121, "sugar", day, 1, D("50.00"), 2, D("100.00"), None),
        (2, 121, "sugar", day, 2, D("50.00"), 1, D("50.00"), None),
        (None, 122, "besan", day, 4, D("52.00"), 1, D("52.00"), None),   # null key
        (9, 121, "maida", day, 3, D("20.00"), 1, D("20.00"), None),      # unknown customer
        (1, 999, "maida", day, 3, D("20.00"), 1, D("20.00"), None),      # unknown store
        (2, 122, "maida", day, 42, D("20.00"), 1, D("20.00"), None),     # unknown person
    ], SALES_SCHEMA)
    customer = spark.createDataFrame(customers, CUSTOMER_SCHEMA)
    store = spark.createDataFrame([(121, "addr", "1", "Mgr1", None, None),
                                   (122, "addr", "2", "Mgr2", None, None)], STORE_SCHEMA)
    team = spark.createDataFrame([(i, f"F{i}", f"L{i}", 10, "N", "a", "p", None)
                                  for i in range(1, 10)], SALES_TEAM_SCHEMA)
    return fact, customer, store, team


def test_inner_joins_drop_unmatched_and_null_keys(spark):
    fact, customer, store, team = _frames(
        spark, [(1, "A", "B", "x", "p", "t", None), (2, "C", "D", "y", "p", "t", None)])
    out = enrich_sales(fact, customer, store, team)
    assert out.columns == list(ENRICHED_COLUMNS)
    rows = sorted((r.customer_id, r.store_manager_name, r.sales_person_first_name)
                  for r in out.collect())
    assert rows == [(1, "Mgr1", "F1"), (2, "Mgr1", "F2")]
    miss = sorted(((r.dimension, r.customer_id, r.store_id) for r in
                   unmatched_facts(fact, customer, store, team).collect()), key=repr)
    assert miss == sorted([("customer", 9, 121), ("customer", None, 122),
                           ("sales_team", 2, 122), ("store", 1, 999)], key=repr)
    # enriched + unmatched facts = conformed facts when dimension keys are unique
    assert out.count() + unmatched_facts(fact, customer, store, team).count() == fact.count()


def test_duplicate_dimension_keys_fan_out(spark):
    fact, customer, store, team = _frames(
        spark, [(1, "A", "B", "x", "p", "t", None), (1, "A2", "B2", "x", "p", "t", None),
                (2, "C", "D", "y", "p", "t", None)])
    out = enrich_sales(fact, customer, store, team)
    assert out.filter("customer_id = 1").count() == 2


def test_carry_keeps_fact_columns(spark):
    fact, customer, store, team = _frames(spark, [(1, "A", "B", "x", "p", "t", None)])
    out = enrich_sales(fact, customer, store, team, carry=("product_name",))
    assert out.columns[-1] == "product_name"
