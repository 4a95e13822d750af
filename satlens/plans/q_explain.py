"""Registered queries: contributions, explanations, comparisons, adjustments and
uncertainty (inventory §2.5 A7-A8, A26-A29, §2.10 M14-M15, M20-M32)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions.scalar import month_start
from satlens.operators import clean, contributions, explain as X, stats, uncertainty as U
from satlens.operators.reshape import explanation_wide
from satlens.plans.oracle_base import MODEL, SCORED
from satlens.plans.registry import Inputs, register, rounded

_SEG = "cabin_in_surveyed_flight, haul"
_G = "PARTITION BY period, base_period, cabin_in_surveyed_flight, haul"
_G1 = "PARTITION BY period, cabin_in_surveyed_flight, haul"


def _sat(tp: str) -> str:
    w = "monthly_weight"
    weighted = (f"CASE WHEN coalesce(sum(CASE WHEN {tp} IS NOT NULL THEN {w} END), 0) <> 0 THEN "
                f"coalesce(sum(CASE WHEN {tp} >= 8 THEN {w} END), 0) / sum(CASE WHEN {tp} IS NOT NULL THEN {w} END) * 100 "
                f"ELSE 0 END")
    counted = f"CASE WHEN count({tp}) > 0 THEN count_if({tp} >= 8) / count({tp}) * 100 ELSE 0 END"
    return f"CASE WHEN count_if({tp} IS NOT NULL AND {w} IS NOT NULL) > 0 THEN {weighted} ELSE {counted} END"


def _data(f: str) -> str:
    if f in C.NUMERIC_FEATURES:
        return f"avg(CAST({f} AS DOUBLE))"
    if f in C.BINARY_FEATURES:
        v = 0 if f == C.OTP else 1
        return f"count_if({f} = {v}) / nullif(count({f}), 0)::DOUBLE * 100"
    return _sat(f)


def expl_ctes(period_sql: str, where: str = "") -> str:
    parts = [f"{period_sql} AS period", _SEG, "avg(base_prob_nps) * 100 AS base_value",
             "avg(out_prob_nps) AS prediction_frac", "count(*) AS n_rows"]
    for f in C.FEATURES:
        parts += [f"avg({f}_nps) * 100 AS v__{f}", f"{_data(f)} AS d__{f}"]
    wide = f"expl_wide AS (SELECT {', '.join(parts)} FROM scored_nps {where} GROUP BY ALL)"
    union = "\nUNION ALL\n".join(
        f"SELECT period, {_SEG}, '{f}' AS feature, {i} AS position, v__{f} AS value, d__{f} AS data, base_value, "
        f"prediction_frac, prediction_frac * 100 AS prediction_pct, n_rows FROM expl_wide"
        for i, f in enumerate(C.FEATURES))
    return f", {wide},\nexpl AS ({union})\n"


_MONTH = "CAST(date_trunc('month', date_flight_local) AS DATE)"
EXPL_M = SCORED + expl_ctes(_MONTH)
_EXPL_COLS = ("period, cabin_in_surveyed_flight, haul, feature, position, round(value, 6) AS value, "
              "round(data, 6) AS data, round(base_value, 6) AS base_value, round(prediction_frac, 6) AS prediction_frac, "
              "round(prediction_pct, 6) AS prediction_pct, n_rows")


def _base_year_sql(y: str) -> str:
    b = f"({y} - 1)"
    ex = ", ".join(str(v) for v in C.EXCLUDED_YEARS)
    for _ in C.EXCLUDED_YEARS:
        b = f"(CASE WHEN {b} IN ({ex}) THEN {b} - 1 ELSE {b} END)"
    return b


def _uplift_cte(base_sql: str) -> str:
    return f""", esum AS (SELECT *, sum(value) OVER ({_G1}) AS psum FROM expl),
cur AS (SELECT *, {base_sql} AS bp FROM expl),
up AS (
SELECT c.period, p.period AS base_period, c.cabin_in_surveyed_flight, c.haul, c.feature, c.position,
  c.value - p.value AS value, c.data - p.data AS data, p.base_value + p.psum AS base_value,
  c.prediction_pct - p.prediction_pct AS prediction_change
FROM cur c JOIN esum p ON c.bp = p.period AND c.cabin_in_surveyed_flight = p.cabin_in_surveyed_flight
  AND c.haul = p.haul AND c.feature = p.feature)
"""


YOY = EXPL_M + _uplift_cte(f"make_date({_base_year_sql('year(period)')}, month(period), 1)")
VS_BASE = EXPL_M + _uplift_cte("DATE '1997-01-01'")
_UP_COLS = ("period, base_period, cabin_in_surveyed_flight, haul, feature, position, round(value, 6) AS value, "
            "round(data, 6) AS data, round(base_value, 6) AS base_value, round(prediction_change, 6) AS prediction_change")
_DIR = ("CASE WHEN feature LIKE '%load_factor%' OR feature LIKE '%price%' OR feature LIKE '%delay%' THEN -1 "
        f"WHEN feature IN ({', '.join(repr(t) for t in C.TOUCHPOINTS + [C.OTP])}) THEN 1 ELSE 0 END")
_ACT = f""", act AS (SELECT {_MONTH} AS period, {_SEG},
  (count_if(nps_100 > 8) - count_if(nps_100 <= 6)) / nullif(count(nps_100), 0)::DOUBLE * 100 AS actual
FROM scored_nps GROUP BY ALL)
"""


# ------------------------------------------------------------ contributions
@register("linear_shap", MODEL + """
, m AS (SELECT avg(CAST(pfl_100_checkin AS DOUBLE)) AS m1, avg(CAST(ifl_300_cabin AS DOUBLE)) AS m2 FROM model_input)
SELECT respondent_id, round(0.4 * (pfl_100_checkin - m1), 6) AS pfl_100_checkin_lin,
  round(-0.1 * (ifl_300_cabin - m2), 6) AS ifl_300_cabin_lin,
  round(-2.0 + 0.4 * m1 - 0.1 * m2, 6) AS base_value_lin,
  round(-2.0 + 0.4 * pfl_100_checkin - 0.1 * ifl_300_cabin, 6) AS out_value_lin
FROM model_input, m""")
def q_linear_shap(x: Inputs):
    t = contributions.linear_contributions(x.model_input, {"pfl_100_checkin": 0.4, "ifl_300_cabin": -0.1},
                                           "_lin", intercept=-2.0)
    return rounded(t.select(C.ID, "pfl_100_checkin_lin", "ifl_300_cabin_lin", "base_value_lin", "out_value_lin"))


@register("shap_to_prob", SCORED + """
SELECT respondent_id,
  round(CASE WHEN sum_prom = 0 THEN 0 ELSE p1 * (out_prob_prom - base_prob_prom) / sum_prom END, 6) AS pfl_100_checkin_prom,
  round(CASE WHEN sum_prom = 0 THEN 0 ELSE p2 * (out_prob_prom - base_prob_prom) / sum_prom END, 6) AS ifl_300_cabin_prom,
  round(CASE WHEN sum_prom = 0 THEN 0 ELSE p3 * (out_prob_prom - base_prob_prom) / sum_prom END, 6) AS ifl_600_wifi_prom,
  round(base_prob_prom, 6) AS base_prob_prom, round(out_prob_prom, 6) AS out_prob_prom
FROM scored_nps""")
def q_shap_to_prob(x: Inputs):
    s = x.scored
    return rounded(s.select(C.ID, *[f"{f}_prom" for f in C.TOUCHPOINTS], "base_prob_prom", "out_prob_prom"))


@register("nps_contrib", SCORED + f"""
SELECT respondent_id, {', '.join(f'round({f}_nps, 6) AS {f}_nps' for f in C.FEATURES)},
  round(base_prob_nps, 6) AS base_prob_nps, round(out_prob_nps, 6) AS out_prob_nps,
  round(uncertainty_nps, 6) AS uncertainty_nps
FROM scored_nps""")
def q_nps_contrib(x: Inputs):
    s = x.scored
    return rounded(s.select(C.ID, *[f"{f}_nps" for f in C.FEATURES], "base_prob_nps", "out_prob_nps",
                            "uncertainty_nps"))


@register("global_importance", SCORED + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, '{m}' AS model, round(avg(abs({f}_{m})), 6) AS mean_abs, round(avg({f}_{m}), 6) AS mean "
    f"FROM scored_nps" for f in C.FEATURES for m in ("nps",)) + "\nUNION ALL\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}', '{m}', round(avg(abs({e})), 6), round(avg({e}), 6) FROM scored_nps"
    for f, e in (("pfl_100_checkin", "CASE WHEN sum_prom = 0 THEN 0 ELSE p1 * (out_prob_prom - base_prob_prom) / sum_prom END"),
                 ("ifl_300_cabin", "CASE WHEN sum_prom = 0 THEN 0 ELSE p2 * (out_prob_prom - base_prob_prom) / sum_prom END"),
                 ("ifl_600_wifi", "CASE WHEN sum_prom = 0 THEN 0 ELSE p3 * (out_prob_prom - base_prob_prom) / sum_prom END"),
                 ("ticket_price", "0.0"), ("load_factor", "0.0"), ("otp15_takeoff", "0.0"))
    for m in ("prom",)))
def q_global_importance(x: Inputs):
    return rounded(stats.global_importance(x.scored, C.FEATURES, suffixes=("_nps", "_prom")))


# ------------------------------------------------------------ explanations
@register("explain_period", EXPL_M + f"SELECT {_EXPL_COLS} FROM expl")
def q_explain_period(x: Inputs):
    return rounded(X.explain_monthly(x.scored))


@register("explain_daily", SCORED + expl_ctes("date_flight_local") + f"SELECT {_EXPL_COLS} FROM expl")
def q_explain_daily(x: Inputs):
    return rounded(X.explain_daily(x.scored))


@register("explanation_wide", EXPL_M + f"""
SELECT period, {_SEG}, {', '.join(f'round(v__{f}, 6) AS {f}_nps' for f in C.FEATURES)} FROM expl_wide""")
def q_explanation_wide(x: Inputs):
    e = X.explain_monthly(x.scored)
    return rounded(explanation_wide(e, [X.PERIOD, *C.SEGMENT], C.FEATURES))


@register("explanation_store", EXPL_M + f"""
SELECT {_EXPL_COLS} FROM expl WHERE period = DATE '2000-02-01'""")
def q_explanation_store(x: Inputs):
    from satlens.session import scratch_path
    from satlens.sources.files import load_explanation, write_explanations
    import uuid
    path = scratch_path(x.spark, f"explanations-{uuid.uuid4().hex}")
    write_explanations(X.explain_monthly(x.scored), path)
    missing = load_explanation(x.spark, path, 1998, 2)  # excluded year: no rows
    got = load_explanation(x.spark, path, 2000, 2)
    return rounded(got.unionByName(missing))


@register("explain_uplift", EXPL_M + f"""
, esum AS (SELECT *, sum(value) OVER ({_G1}) AS psum FROM expl)
SELECT c.period, p.period AS base_period, c.cabin_in_surveyed_flight, c.haul, c.feature, c.position,
  round(c.value - p.value, 6) AS value, round(c.data - p.data, 6) AS data, round(p.base_value + p.psum, 6) AS base_value,
  round(c.prediction_pct - p.prediction_pct, 6) AS prediction_change
FROM expl c JOIN esum p ON p.period = DATE '1997-02-01' AND c.cabin_in_surveyed_flight = p.cabin_in_surveyed_flight
  AND c.haul = p.haul AND c.feature = p.feature
WHERE c.period = DATE '2000-02-01'""")
def q_explain_uplift(x: Inputs):
    e = X.explain_monthly(x.scored)
    cur = e.filter(F.col(X.PERIOD) == F.lit(dt.date(2000, 2, 1)))
    prev = e.filter(F.col(X.PERIOD) == F.lit(dt.date(1997, 2, 1)))
    on = [(s, s) for s in C.SEGMENT] + [("feature", "feature")]
    return rounded(X.uplift(cur, prev, on))


@register("explain_yoy", YOY + f"SELECT {_UP_COLS} FROM up")
def q_explain_yoy(x: Inputs):
    return rounded(X.explain_yoy(X.explain_monthly(x.scored)))


@register("explain_vs_base", VS_BASE + f"SELECT {_UP_COLS} FROM up")
def q_explain_vs_base(x: Inputs):
    return rounded(X.explain_vs_base(X.explain_monthly(x.scored), dt.date(1997, 1, 1)))


@register("feature_direction", EXPL_M + f"SELECT DISTINCT feature, {_DIR} AS direction FROM expl")
def q_feature_direction(x: Inputs):
    e = X.explain_monthly(x.scored)
    return e.select("feature").distinct().withColumn("direction", X.direction(F.col("feature")))


def _flip_sql(mode: str) -> str:
    if mode == "conflict":
        neg = "(sign(v) <> 0 AND sign(v) = -direction * sign(data))"
    else:
        neg = "((direction = 1 AND sign(data) = sign(v)) OR (direction = -1 AND sign(data) <> sign(v)))"
    return YOY + f""", f1 AS (SELECT *, {_DIR} AS direction, CASE WHEN data = 0 THEN 0.0 ELSE value END AS v FROM up),
f2 AS (SELECT *, (data <> 0 AND {neg}) AS flipped, sum(value) OVER ({_G}) AS total FROM f1),
f3 AS (SELECT *, CASE WHEN flipped THEN -v ELSE v END AS v2 FROM f2),
f4 AS (SELECT *, sum(CASE WHEN data <> 0 THEN v2 END) OVER ({_G}) AS nz FROM f3)
SELECT period, base_period, {_SEG}, feature, direction, flipped, round(value, 6) AS value,
  round(CASE WHEN data <> 0 THEN v2 * (CASE WHEN coalesce(nz, 0) <> 0 THEN total / nz ELSE 1 END) ELSE v2 END, 6) AS adjusted
FROM f4"""


_FLIP_OUT = ["period", "base_period", *C.SEGMENT, "feature", "direction", "flipped", "value", "adjusted"]


@register("flip_negate", _flip_sql("conflict"))
def q_flip_negate(x: Inputs):
    f = X.flip_negate(X.explain_yoy(X.explain_monthly(x.scored)), flip_when="conflict")
    return rounded(f.select(*_FLIP_OUT))


@register("flip_negate_code", _flip_sql("code"))
def q_flip_negate_code(x: Inputs):
    f = X.flip_negate(X.explain_yoy(X.explain_monthly(x.scored)), flip_when="code")
    return rounded(f.select(*_FLIP_OUT))


@register("flip_zero_share", YOY + f""", z1 AS (SELECT *, {_DIR} AS direction FROM up),
z2 AS (SELECT *, (sign(value) <> 0 AND sign(value) = -direction * sign(data) AND direction <> 0) AS wrong FROM z1),
z3 AS (SELECT *,
  sum(CASE WHEN wrong AND value > 0 THEN value ELSE 0 END) OVER ({_G}) AS wp,
  sum(CASE WHEN wrong AND value < 0 THEN value ELSE 0 END) OVER ({_G}) AS wn,
  sum(CASE WHEN NOT wrong AND value > 0 THEN value ELSE 0 END) OVER ({_G}) AS rp,
  sum(CASE WHEN NOT wrong AND value < 0 THEN -value ELSE 0 END) OVER ({_G}) AS rn FROM z2)
SELECT period, base_period, {_SEG}, feature, direction, wrong, round(value, 6) AS value,
  round(CASE WHEN wrong AND value > 0 THEN (CASE WHEN rp > 0 THEN 0 ELSE value END)
       WHEN wrong AND value < 0 THEN (CASE WHEN rn > 0 THEN 0 ELSE value END)
       WHEN value > 0 THEN value + CASE WHEN rp > 0 THEN wp * value / rp ELSE 0 END
       WHEN value < 0 THEN value + CASE WHEN rn > 0 THEN wn * (-value) / rn ELSE 0 END
       ELSE value END, 6) AS adjusted
FROM z3""")
def q_flip_zero_share(x: Inputs):
    f = X.flip_zero_share(X.explain_yoy(X.explain_monthly(x.scored)))
    return rounded(f.select("period", "base_period", *C.SEGMENT, "feature", "direction", "wrong", "value", "adjusted"))


def _adjust_sql(method: str) -> str:
    if method == "direct":
        use = "false"
    elif method == "indirect":
        use = "(p > 0 AND n > 0)"
    else:
        use = "(p > 0 AND n > 0 AND sign(s) * sign(d) < 0)"
    return f""", a1 AS (SELECT e.*, a.actual FROM expl e JOIN act a USING (period, {_SEG})),
a2 AS (SELECT *, sum(value) OVER ({_G1}) AS s, sum(CASE WHEN value > 0 THEN value ELSE 0 END) OVER ({_G1}) AS p,
  -sum(CASE WHEN value < 0 THEN value ELSE 0 END) OVER ({_G1}) AS n, actual - base_value AS d FROM a1),
a3 AS (SELECT *, {use} AS use_ind, (d + sqrt(d * d + 4 * p * n)) / nullif(2 * p, 0) AS k FROM a2),
a4 AS (SELECT *, CASE WHEN use_ind THEN 'indirect' ELSE 'direct' END AS method_used,
  CASE WHEN use_ind THEN (CASE WHEN value > 0 THEN value * k ELSE value / k END)
       ELSE value * (CASE WHEN s <> 0 THEN d / s ELSE 0 END) END AS adjusted, d - s AS error FROM a3),
adj AS (SELECT *, abs(base_value + sum(adjusted) OVER ({_G1}) - actual) <= 1e-6 AS matches FROM a4)
"""


_ADJ_COLS = (f"period, {_SEG}, feature, round(value, 6) AS value, round(actual, 6) AS actual, method_used, "
             "round(adjusted, 6) AS adjusted, round(error, 6) AS error, matches")
_ADJ_OUT = ["period", *C.SEGMENT, "feature", "value", "actual", "method_used", "adjusted", "error", "matches"]


def _adjusted(x: Inputs, method: str):
    e = X.explain_monthly(x.scored)
    act = X.actual_nps(x.scored, month_start(C.DATE))
    return X.adjust_to_actual(e, act, method=method)


@register("mae_direct", EXPL_M + _ACT + _adjust_sql("direct") + f"SELECT {_ADJ_COLS} FROM adj")
def q_mae_direct(x: Inputs):
    return rounded(_adjusted(x, "direct").select(*_ADJ_OUT))


@register("mae_indirect", EXPL_M + _ACT + _adjust_sql("indirect") + f"SELECT {_ADJ_COLS} FROM adj")
def q_mae_indirect(x: Inputs):
    return rounded(_adjusted(x, "indirect").select(*_ADJ_OUT))


@register("mae_auto", EXPL_M + _ACT + _adjust_sql("auto") + f"SELECT {_ADJ_COLS} FROM adj")
def q_mae_auto(x: Inputs):
    return rounded(_adjusted(x, "auto").select(*_ADJ_OUT))


@register("waterfall", EXPL_M + _ACT + _adjust_sql("direct") + f"""
, wf AS (SELECT *, base_value + coalesce(sum(adjusted) OVER ({_G1} ORDER BY position
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM adj)
SELECT period, {_SEG}, feature, position, round(value, 6) AS original, round(adjusted, 6) AS adjusted,
  round(value - adjusted, 6) AS difference, round(start, 6) AS start, round(start + adjusted, 6) AS "end"
FROM wf""")
def q_waterfall(x: Inputs):
    return rounded(X.waterfall(_adjusted(x, "direct")))


@register("nps_mae", EXPL_M + _ACT + f"""
, per AS (SELECT DISTINCT period, {_SEG}, prediction_pct FROM expl)
SELECT {_SEG}, count(*) AS n_periods, round(avg(abs(prediction_pct - actual)), 6) AS mae
FROM per JOIN act USING (period, {_SEG}) GROUP BY ALL""")
def q_nps_mae(x: Inputs):
    e = X.explain_monthly(x.scored)
    return rounded(X.nps_mae(e, X.actual_nps(x.scored, month_start(C.DATE))))


# ------------------------------------------------------------ uncertainty
@register("confidence_tier", SCORED + """
, q AS (SELECT quantile_cont(uncertainty_nps, 0.5) AS q1, quantile_cont(uncertainty_nps, 0.85) AS q2 FROM scored_nps)
SELECT respondent_id, CASE WHEN uncertainty_nps < q1 THEN 'High' WHEN uncertainty_nps < q2 THEN 'Medium' ELSE 'Low' END
  AS confidence_level
FROM scored_nps, q""")
def q_confidence_tier(x: Inputs):
    return U.confidence_tier(x.scored).select(C.ID, "confidence_level")


_BARS = f""", bars AS (
SELECT {_MONTH} AS period, {_SEG}, count(out_prob_nps) AS n, avg(out_prob_nps) * 100 AS prediction_pct,
  avg(uncertainty_nps) * 100 AS systematic_pct, stddev_samp(out_prob_nps) / sqrt(count(out_prob_nps)) * 100 AS sem_pct,
  (count_if(nps_100 > 8) - count_if(nps_100 <= 6)) / nullif(count(nps_100), 0)::DOUBLE * 100 AS actual
FROM scored_nps GROUP BY ALL),
bars2 AS (SELECT *, sqrt(systematic_pct * systematic_pct + coalesce(sem_pct, 0) * coalesce(sem_pct, 0)) AS total_error_pct FROM bars)
"""


@register("error_bars", SCORED + _BARS + f"""
SELECT period, {_SEG}, n, round(prediction_pct, 6) AS prediction_pct, round(systematic_pct, 6) AS systematic_pct,
  round(sem_pct, 6) AS sem_pct, round(actual, 6) AS actual, round(total_error_pct, 6) AS total_error_pct FROM bars2""")
def q_error_bars(x: Inputs):
    return rounded(U.error_bars(x.scored, month_start(C.DATE)))


@register("trust_verdict", EXPL_M + _ACT + _adjust_sql("auto") + _BARS + f"""
, ind AS (SELECT period, {_SEG}, max(CAST(method_used = 'indirect' AS INTEGER)) AS ind FROM adj GROUP BY ALL),
q AS (SELECT quantile_cont(total_error_pct, 0.5) AS q1, quantile_cont(total_error_pct, 0.85) AS q2 FROM bars2)
SELECT b.period, b.{_SEG.replace(', ', ', b.')}, round(b.total_error_pct, 6) AS total_error_pct,
  CASE WHEN b.actual IS NULL THEN 'no data'
       WHEN abs(b.actual - b.prediction_pct) > b.total_error_pct THEN 'not trusted: outside error'
       WHEN coalesce(ind.ind, 0) = 1 THEN 'not trusted: indirect adjustment'
       ELSE 'trusted: ' || CASE WHEN b.total_error_pct < q.q1 THEN 'High' WHEN b.total_error_pct < q.q2 THEN 'Medium' ELSE 'Low' END
  END AS verdict
FROM bars2 b LEFT JOIN ind ON b.period = ind.period AND b.cabin_in_surveyed_flight = ind.cabin_in_surveyed_flight
  AND b.haul = ind.haul, q""")
def q_trust_verdict(x: Inputs):
    bars = U.error_bars(x.scored, month_start(C.DATE))
    v = U.trust_verdict(bars, _adjusted(x, "auto"))
    return rounded(v.select(X.PERIOD, *C.SEGMENT, "total_error_pct", "verdict"))


@register("sample_uncertainty", SCORED + """
, s AS (SELECT respondent_id, out_prob_nps, uncertainty_nps, CAST(unnest(range(0, 10)) AS INTEGER) AS sample FROM scored_nps),
h AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY
        md5(CAST(respondent_id AS VARCHAR) || '-42-' || CAST(sample AS VARCHAR)), respondent_id) AS rn FROM s)
SELECT sample, count(*) AS n, round(avg(out_prob_nps), 6) AS mean_prediction,
  round(avg(uncertainty_nps), 6) AS model_uncertainty, round(stddev_samp(out_prob_nps) / sqrt(count(out_prob_nps)), 6) AS sem,
  round(avg(uncertainty_nps) + stddev_samp(out_prob_nps) / sqrt(count(out_prob_nps)), 6) AS total_uncertainty
FROM h WHERE rn <= 100 GROUP BY sample""")
def q_sample_uncertainty(x: Inputs):
    return rounded(U.sample_uncertainty(x.scored, 10, 100, seed=42))


@register("uncertainty_curve", SCORED + """
, h AS (SELECT respondent_id, out_prob_nps, uncertainty_nps, nps_100, row_number() OVER (ORDER BY
        md5(CAST(respondent_id AS VARCHAR) || '-42-0'), respondent_id) AS rn FROM scored_nps),
sizes AS (SELECT CAST(s AS INTEGER) AS sample_size FROM range(100, 3001, 50) t(s)),
per AS (SELECT sample_size, avg(out_prob_nps) AS mean_prediction, avg(uncertainty_nps) AS model_uncertainty,
  stddev_samp(out_prob_nps) / sqrt(count(*)) AS sem,
  (count_if(nps_100 > 8) - count_if(nps_100 <= 6)) / nullif(count(nps_100), 0)::DOUBLE AS nps
  FROM sizes JOIN h ON h.rn <= sizes.sample_size GROUP BY sample_size HAVING count(*) = sample_size)
SELECT sizes.sample_size, least(sizes.sample_size, (SELECT count(*) FROM h)) AS n_rows, round(mean_prediction, 6) AS mean_prediction, round(model_uncertainty, 6) AS model_uncertainty,
  round(sem, 6) AS sem, round(sqrt(model_uncertainty * model_uncertainty + sem * sem), 6) AS total_uncertainty,
  round(nps, 6) AS nps, round(sqrt(model_uncertainty * model_uncertainty + sem * sem) / mean_prediction, 6) AS rel_uncertainty
FROM sizes LEFT JOIN per ON sizes.sample_size = per.sample_size""")
def q_uncertainty_curve(x: Inputs):
    return rounded(U.uncertainty_curve(x.scored, n_iterations=1, seed=42))


@register("explain_period_halfopen", SCORED + expl_ctes(
    _MONTH, "WHERE date_flight_local < last_day(date_flight_local)") + f"SELECT {_EXPL_COLS} FROM expl")
def q_explain_period_halfopen(x: Inputs):
    """Monthly windows [first, last) as the notebooks cut them (last day left out)."""
    return rounded(X.explain_monthly(x.scored, closed="left"))


@register("explain_daily_calendar", SCORED + expl_ctes("date_flight_local") + f"""
, seg AS (SELECT DISTINCT cabin_in_surveyed_flight, haul FROM expl),
cal AS (SELECT CAST(d AS DATE) AS period, cabin_in_surveyed_flight, haul, f.feature, f.position
        FROM seg, range(DATE '1996-01-01', DATE '2001-12-31' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d),
        (VALUES {', '.join(f"('{f}', {i})" for i, f in enumerate(C.FEATURES))}) f(feature, position))
SELECT cal.period, cal.cabin_in_surveyed_flight, cal.haul, cal.feature, cal.position,
  round(e.value, 6) AS value, round(e.data, 6) AS data, round(e.base_value, 6) AS base_value,
  round(e.prediction_frac, 6) AS prediction_frac, round(e.prediction_pct, 6) AS prediction_pct, e.n_rows
FROM cal LEFT JOIN expl e ON cal.period = e.period AND cal.cabin_in_surveyed_flight IS NOT DISTINCT FROM e.cabin_in_surveyed_flight
  AND cal.haul IS NOT DISTINCT FROM e.haul AND cal.feature = e.feature AND cal.position = e.position""")
def q_explain_daily_calendar(x: Inputs):
    """Every day from 1996 to 2001 for every segment; empty days are NULL rows."""
    return rounded(X.calendar_fill(X.explain_daily(x.scored), dt.date(1996, 1, 1), dt.date(2001, 12, 31)))
