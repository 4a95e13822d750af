"""Explanation algebra: rescale, uplift telescoping, sign corrections and
adjustments to the observed NPS (SURVEY §5 property tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import contributions, explain as X

P1, P0 = dt.date(2000, 1, 1), dt.date(1997, 1, 1)
SCHEMA = ("period date, cabin_in_surveyed_flight string, haul string, feature string, position int, "
          "value double, data double, base_value double, prediction_frac double, prediction_pct double, n_rows long")


def expl(spark, period, values, data, base=10.0):
    feats = ["ticket_price", "load_factor", "pfl_100_checkin", "ifl_300_cabin"]
    rows = [(period, "Economy", "SH", f, i, float(v), float(d), base, 0.0, base + sum(values), 10)
            for i, (f, v, d) in enumerate(zip(feats, values, data))]
    return spark.createDataFrame(rows, SCHEMA)


def test_zero_sum_rescale(spark):
    df = spark.createDataFrame([(1.0, -1.0, 0.0, 0.3)], "a_prom double, b_prom double, base_value_prom double, out_prob_prom double")
    r = contributions.to_probability(df, ["a", "b"], "_prom").first()
    assert r.a_prom == 0.0 and r.b_prom == 0.0


def test_rescale_adds_up(spark):
    df = spark.createDataFrame([(0.4, 0.2, -1.0)], "a_prom double, b_prom double, base_value_prom double")
    df = df.withColumn("out_prob_prom", 1 / (1 + F.exp(-(F.col("base_value_prom") + 0.6))))
    r = contributions.to_probability(df, ["a", "b"], "_prom").first()
    assert r.a_prom + r.b_prom == pytest.approx(r.out_prob_prom - r.base_prob_prom, abs=1e-12)


def test_uplift_telescopes(spark):
    cur = expl(spark, P1, [1.0, -2.0, 3.0, 0.5], [5, 6, 7, 8])
    prev = expl(spark, P0, [0.5, -1.0, 1.0, 0.0], [4, 6, 9, 8], base=12.0)
    on = [(s, s) for s in C.SEGMENT] + [("feature", "feature")]
    up = X.uplift(cur, prev, on).collect()
    base = up[0].base_value
    assert base == pytest.approx(12.0 + 0.5)
    # previous base + previous total + sum of uplifts = previous base + current total
    assert base + sum(r.value for r in up) == pytest.approx(12.0 + 2.5)


@pytest.mark.parametrize("values,data", [
    ([1.0, 2.0, -1.0, -0.5], [1, 1, 1, 1]),      # some wrong
    ([-1.0, -2.0, 1.0, 0.5], [1, 1, 1, 1]),      # none wrong
    ([1.0, 2.0, 3.0, 4.0], [0, 0, 0, 0]),        # data all zero
])
def test_flip_negate_keeps_total(spark, values, data):
    e = expl(spark, P1, values, data).withColumn("base_period", F.lit(P0))
    for mode in ("conflict", "code"):
        rows = X.flip_negate(e, flip_when=mode).collect()
        nz = [r for r in rows if r.data != 0]
        if nz and sum(r.adjusted for r in rows) != 0:
            assert sum(r.adjusted for r in rows) == pytest.approx(sum(values), abs=1e-9)
        for r in rows:
            if r.data == 0:
                assert r.adjusted == 0.0


def test_flip_conflict_semantics(spark):
    # price (-1): data up and value up is wrong; checkin (+1): data up and value down is wrong.
    e = expl(spark, P1, [2.0, -1.0, -1.0, 3.0], [1, 1, 1, 1]).withColumn("base_period", F.lit(P0))
    got = {r.feature: r.flipped for r in X.flip_negate(e, flip_when="conflict").collect()}
    assert got == {"ticket_price": True, "load_factor": False, "pfl_100_checkin": True, "ifl_300_cabin": False}


def test_flip_zero_share(spark):
    e = expl(spark, P1, [2.0, -1.0, -1.0, 3.0], [1, 1, 1, 1]).withColumn("base_period", F.lit(P0))
    rows = {r.feature: r for r in X.flip_zero_share(e).collect()}
    assert rows["ticket_price"].adjusted == 0.0 and rows["pfl_100_checkin"].adjusted == 0.0
    # +2 of the wrong price goes to the other positive (cabin), -1 of checkin to load factor
    assert rows["ifl_300_cabin"].adjusted == pytest.approx(5.0)
    assert rows["load_factor"].adjusted == pytest.approx(-2.0)
    assert sum(r.adjusted for r in rows.values()) == pytest.approx(3.0)


@pytest.mark.parametrize("values,actual", [
    ([2.0, -1.0, 0.5, 0.5], 5.0),     # predicted +2, actual -5 relative to base 10
    ([0.0, 1.0, 2.0, 0.0], 4.0),      # no negatives -> direct
    ([-1.0, -2.0, 0.0, 0.0], 15.0),   # no positives -> direct
    ([2.0, -1.0, 0.0, 0.0], 10.0),    # zero change
])
def test_adjust_to_actual_hits_target(spark, values, actual):
    e = expl(spark, P1, values, [1, 1, 1, 1])
    act = spark.createDataFrame([(P1, "Economy", "SH", actual)],
                                "period date, cabin_in_surveyed_flight string, haul string, actual double")
    for method in ("direct", "indirect", "auto"):
        rows = X.adjust_to_actual(e, act, method=method).collect()
        total = sum(r.adjusted for r in rows)
        if sum(values) != 0 or method != "direct":
            assert 10.0 + total == pytest.approx(actual, abs=1e-9)
            assert all(r.matches for r in rows)
        if method != "direct" and rows[0].method_used == "indirect":
            for r, v in zip(sorted(rows, key=lambda r: r.position), values):
                assert r.adjusted * v >= 0      # indirect never changes a sign


def test_waterfall_running_start(spark):
    e = expl(spark, P1, [1.0, 2.0, -1.0, 0.5], [1, 1, 1, 1])
    act = spark.createDataFrame([(P1, "Economy", "SH", 15.0)],
                                "period date, cabin_in_surveyed_flight string, haul string, actual double")
    w = sorted(X.waterfall(X.adjust_to_actual(e, act, method="direct")).collect(), key=lambda r: r.position)
    assert w[0].start == 10.0
    for a, b in zip(w, w[1:]):
        assert b.start == pytest.approx(a.end)
    assert w[-1].end == pytest.approx(15.0)
