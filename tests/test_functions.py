"""Edge cases of row-level and aggregate expressions (FIXTURES §C)."""

import datetime as dt
import math

import pytest

from pyspark.sql import functions as F

from satlens.functions import aggregates as A
from satlens.functions import scalar as S


def test_late_flag_nan_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (15.0,), (15.01,)], "delay double")
    got = [r[0] for r in df.select(S.late_flag("delay")).collect()]
    assert got == [0, 0, 0, 1]


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(0.0, 0), (5.0, 0), (5.0, 10)], "pax double, cap long")
    got = [r[0] for r in df.select(S.safe_ratio("pax", "cap")).collect()]
    assert got == [None, None, 0.5]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(6,), (8,), (10,), (-1,), (11,), (7,)], "x int")
    got = [r[0] for r in df.select(S.cut_label("x", [-1, 6, 8, 10])).collect()]
    assert got == ["(-1, 6]", "(6, 8]", "(8, 10]", None, None, "(6, 8]"]


def test_parse_dates_and_month_end(spark):
    df = spark.createDataFrame([("20240102 10:11:12",), ("bad",), (None,)], "t string")
    got = df.select(S.parse_timestamp("t").alias("p"), S.parse_ok("t").alias("ok")).collect()
    assert got[0].p == dt.datetime(2024, 1, 2, 10, 11, 12)
    assert got[1].p is None and got[1].ok is False
    assert got[2].p is None and got[2].ok is True
    d = spark.createDataFrame([(dt.date(2024, 2, 10),)], "d date")
    assert d.select(S.month_end("d")).first()[0] == dt.date(2024, 2, 29)


def test_duration_and_weekday(spark):
    df = spark.createDataFrame([("01:02:03",), ("1 days 00:00:10",), ("junk",)], "t string")
    got = [r[0] for r in df.select(S.duration_seconds("t")).collect()]
    assert got == [3723.0, 86410.0, None]
    d = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),)], "d date")  # Mon, Sat
    assert [tuple(r) for r in d.select(S.weekday("d"), S.weekend_flag("d")).collect()] == [(0, 0), (5, 1)]


def test_group_by_lists_later_wins(spark):
    df = spark.createDataFrame([("MA",), ("ES",), ("XX",)], "c string")
    groups = {"EUROPA": ["ES", "MA"], "AFRICA": ["MA"]}
    got = [r[0] for r in df.select(S.group_by_lists("c", groups)).collect()]
    assert got == ["AFRICA", "EUROPA", "Others"]


def test_nps_empty_group(spark):
    df = spark.createDataFrame([(1, None), (2, 9), (2, 3)], "g int, s int")
    got = {r.g: (r.frac, r.pct) for r in df.groupBy("g").agg(
        A.nps("s").alias("frac"), A.nps("s", scale=100.0, empty=0.0).alias("pct")).collect()}
    assert got[1] == (None, 0.0)
    assert got[2] == (0.0, 0.0)


def test_weighted_nps_and_satisfaction_fallbacks(spark):
    rows = [("all_null", 9, None), ("all_null", 3, None),
            ("some", 9, 2.0), ("some", 9, None), ("some", 5, 1.0),
            ("noans", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, s int, w double")
    got = {r.g: (r.wn, r.sat) for r in df.groupBy("g").agg(
        A.weighted_nps("s", "w").alias("wn"), A.satisfaction("s", "w").alias("sat")).collect()}
    assert got["all_null"] == (0.0, 50.0)                 # no weights: counts
    assert math.isclose(got["some"][0], (2.0 - 1.0) / 3.0 * 100)
    assert math.isclose(got["some"][1], 2.0 / 3.0 * 100)   # weighted: 2 of 3 weight satisfied
    assert got["noans"][1] == 0.0
    noweight = df.drop("w").groupBy("g").agg(A.satisfaction("s", None).alias("sat"))
    assert {r.g: r.sat for r in noweight.collect()}["some"] == pytest.approx(200.0 / 3.0)
