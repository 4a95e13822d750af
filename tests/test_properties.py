"""Property tests: adjustments hit their target totals and the
indirect adjustment never changes a sign, for random explanations."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from satlens.operators import explain as X

P1 = dt.date(2000, 1, 1)
SCHEMA = ("period date, cabin_in_surveyed_flight string, haul string, feature string, position int, "
          "value double, data double, base_value double, prediction_frac double, prediction_pct double, n_rows long")
FEATS = ["ticket_price", "load_factor", "otp15_takeoff", "pfl_100_checkin", "ifl_300_cabin"]
vals = st.floats(min_value=-20, max_value=20, allow_nan=False).map(lambda v: round(v, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(vals, min_size=5, max_size=5), data=st.lists(st.sampled_from([-1.0, 0.0, 2.0]), min_size=5,
                                                                       max_size=5),
       base=vals, actual=vals)
def test_adjustments_hit_target(spark, values, data, base, actual):
    rows = [(P1, "Economy", "SH", f, i, v, d, base, 0.0, 0.0, 5) for i, (f, v, d) in enumerate(zip(FEATS, values, data))]
    e = spark.createDataFrame(rows, SCHEMA)
    act = spark.createDataFrame([(P1, "Economy", "SH", actual)],
                                "period date, cabin_in_surveyed_flight string, haul string, actual double")
    pos, neg = sum(v for v in values if v > 0), -sum(v for v in values if v < 0)
    for method in ("direct", "indirect", "auto"):
        out = X.adjust_to_actual(e, act, method=method).collect()
        total = sum(r.adjusted for r in out)
        reachable = sum(values) != 0 or (method != "direct" and pos > 0 and neg > 0)
        if reachable:
            assert base + total == pytest.approx(actual, abs=1e-6)
        for r in out:
            if r.method_used == "indirect":
                assert r.adjusted * r.value >= 0
    # sign corrections keep the group total whenever a rescale is possible
    e2 = e.withColumn("base_period", e.period)
    for mode in ("conflict", "code"):
        f = X.flip_negate(e2, flip_when=mode).collect()
        if any(r.data != 0 for r in f) and sum(r.adjusted for r in f if r.data != 0) != 0:
            assert sum(r.adjusted for r in f) == pytest.approx(sum(values), abs=1e-6)
    z = X.flip_zero_share(e2).collect()
    assert sum(r.adjusted for r in z) == pytest.approx(sum(values), abs=1e-6)
