"""Properties: header parsing round-trips; monthly total and ledger state match their definitions."""

import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions import header_fields

# Single-line names that aren't blank, drawn from an alphabet that exercises
# quoting: commas, quotes, spaces (also around a name: names are not trimmed).
NAME = st.text(alphabet=st.sampled_from(list('ab_Z9 ,"')), min_size=1, max_size=8).filter(str.strip)
HEADER = st.lists(NAME, min_size=1, max_size=6)


def _line(names):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(names)
    return buf.getvalue()


@settings(max_examples=15, deadline=None)
@given(st.lists(HEADER, min_size=1, max_size=20))
def test_header_fields_roundtrip(spark, headers):
    lines = [(i, _line(h)) for i, h in enumerate(headers)]
    df = spark.createDataFrame(lines, "i int, line string")
    got = {r.i: list(r.h) for r in df.select("i", header_fields("line").alias("h")).collect()}
    assert [got[i] for i in range(len(headers))] == headers


ROW = st.tuples(
    st.integers(1, 3),
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["x", None]),
    st.sampled_from(["p", "q"]),
    st.sampled_from([None, "1"]),
    st.sampled_from(["2023-01-05", "2023-01-20", "2023-02-01", "2023-03-31"]),
    st.integers(0, 99_999),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=40))
def test_monthly_total_equals_window_distinct_definition(spark, rows):
    import datetime as dt
    from decimal import Decimal as D

    from tillroll.operators import marts

    data = [(c, f, l, a, ph, dt.date.fromisoformat(d), D(cents) / 100)
            for c, f, l, a, ph, d, cents in rows]
    mart = spark.createDataFrame(
        data, "customer_id int, first_name string, last_name string, address string, "
              "phone_number string, sales_date date, total_cost decimal(12,2)")
    mart = mart.withColumn("pincode", mart.address)
    total, variants = {}, set()
    for c, f, l, a, ph, d, cost in data:
        total[c, d.isoformat()[:7]] = total.get((c, d.isoformat()[:7]), D(0)) + cost
        variants.add((c, None if f is None or l is None else f"{f} {l}", a, ph, d.isoformat()[:7]))
    got = [tuple(r) for r in marts.customer_monthly_total(mart).collect()]
    assert sorted(got, key=str) == sorted(((*v, total[v[0], v[4]]) for v in variants), key=str)


EVENT = st.tuples(st.sampled_from(["f1", "f2", "f3"]), st.sampled_from(["A", "I"]),
                  st.integers(0, 3), st.integers(0, 1000))


@settings(max_examples=10, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=30, unique_by=lambda e: (e[0], e[2], e[3])))
def test_ledger_current_is_latest_event(spark, events):
    import datetime as dt

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tillroll.operators import ledger

    t0 = dt.datetime(2024, 1, 1)
    rows = [("r", f, f, s, t0 + dt.timedelta(hours=h), seq) for f, s, h, seq in events]
    ev = spark.createDataFrame(rows, "run_id string, file_name string, file_location string, "
                                     "status string, event_ts timestamp, seq bigint")
    w = Window.partitionBy("file_location").orderBy(F.desc("event_ts"), F.desc("seq"))
    expect = ev.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    got = ledger.ledger_current(ev)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
