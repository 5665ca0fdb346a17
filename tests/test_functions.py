import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillroll.functions import cents, fold_columns, from_cents, full_name, header_fields, month_key


def test_header_fields_respects_quotes(spark):
    df = spark.createDataFrame([('a,"b,c", "d",,e ',), ("x",), ("",), ('"say ""hi""",y',)],
                               "line string")
    got = [r.h for r in df.select(header_fields("line").alias("h")).collect()]
    # names are not trimmed; a blank one is called by its position
    assert got == [["a", "b,c", ' "d"', "_c3", "e "], ["x"], ["_c0"], ['say "hi"', "y"]]


def test_fold_full_name_month(spark):
    df = spark.createDataFrame([("a", None, "c", dt.date(2023, 1, 31)),
                                (None, None, None, dt.date(1999, 12, 1))],
                               "x string, y string, z string, d date")
    rows = df.select(fold_columns(["x", "y", "z"]).alias("f"), full_name("x", "z").alias("n"),
                     month_key("d").alias("m")).collect()
    assert [(r.f, r.n, r.m) for r in rows] == [("a,c", "a c", "2023-01"), ("", None, "1999-12")]


def test_cents_round_trip_is_exact(spark):
    vals = [D("0.01"), D("1.50"), D("9999999999.99"), D("-3.10")]
    df = spark.createDataFrame([(v,) for v in vals], "m decimal(12,2)")
    total = df.select(from_cents(F.sum(cents("m"))).alias("t")).first().t
    assert total == sum(vals)
