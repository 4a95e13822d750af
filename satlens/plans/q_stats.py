"""Registered queries: aggregations, joins/audits, reshape, windows, sort and
set operations (inventory §2.3-2.8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions import scalar as S
from satlens.operators import joins, nps, reshape, stats, windows
from satlens.plans.oracle_base import BASE, LOAD_FACTOR, MODEL, SCORED, SURVEY, with_ctes
from satlens.plans.registry import Inputs, r6, register, rounded
from satlens.sources import testdata as td

_MONTH = "CAST(date_trunc('month', date_flight_local) AS DATE)"
LF_BASE = with_ctes(SURVEY, LOAD_FACTOR)


# ---------------------------------------------------------------- aggregates
@register("lf_by_month_haul", LF_BASE + """
SELECT flight_date_local AS month, haul,
  round(sum(pax_business) / nullif(sum(capacity_business), 0), 6) AS lf_business,
  round(sum(pax_premium_ec) / nullif(sum(capacity_premium_ec), 0), 6) AS lf_premium_ec,
  round(sum(pax_economy) / nullif(sum(capacity_economy), 0), 6) AS lf_economy
FROM load_factor GROUP BY ALL""")
def q_lf_by_month_haul(x: Inputs):
    lf = x.load_factor
    return lf.groupBy(F.col("flight_date_local").alias("month"), C.HAUL).agg(
        *[r6(S.safe_ratio(F.sum(f"pax_{c}"), F.sum(f"capacity_{c}"))).alias(f"lf_{c}")
          for c in ("business", "premium_ec", "economy")])


@register("target_encode", MODEL + """
, enc AS (SELECT cabin_in_surveyed_flight, avg(promoter_binary) - avg(detractor_binary) AS te FROM model_input GROUP BY ALL)
SELECT m.respondent_id, m.cabin_in_surveyed_flight, round(enc.te, 6) AS cabin_te
FROM model_input m LEFT JOIN enc ON m.cabin_in_surveyed_flight IS NOT DISTINCT FROM enc.cabin_in_surveyed_flight""")
def q_target_encode(x: Inputs):
    t = joins.target_encode(x.model_input.select(C.ID, C.CABIN, C.PROMOTER, C.DETRACTOR), C.CABIN,
                            C.PROMOTER, C.DETRACTOR, "cabin_te")
    return t.select(C.ID, C.CABIN, r6("cabin_te").alias("cabin_te"))


@register("nps_weighted", MODEL + f"""
SELECT {_MONTH} AS flight_month, cabin_in_surveyed_flight,
  round(CASE WHEN sum(monthly_weight) > 0 THEN
    (coalesce(sum(CASE WHEN nps_100 > 8 THEN monthly_weight END), 0)
     - coalesce(sum(CASE WHEN nps_100 <= 6 THEN monthly_weight END), 0)) / sum(monthly_weight) * 100
  ELSE 0 END, 6) AS nps_weighted,
  round(sum(monthly_weight), 6) AS weight_sum
FROM model_input GROUP BY ALL""")
def q_nps_weighted(x: Inputs):
    return rounded(nps.weighted_nps_by(x.model_input, [S.month_start(C.DATE).alias("flight_month"), C.CABIN]))


@register("nps_monthly", MODEL + f"""
SELECT {_MONTH} AS month, count_if(nps_100 <= 6) AS detractors, count_if(nps_100 > 6 AND nps_100 <= 8) AS passives,
  count_if(nps_100 > 8) AS promoters, count(nps_100) AS n_answers,
  round(coalesce((count_if(nps_100 > 8) - count_if(nps_100 <= 6)) / nullif(count(nps_100), 0)::DOUBLE * 100, 0), 6) AS nps
FROM model_input GROUP BY ALL""")
def q_nps_monthly(x: Inputs):
    return rounded(nps.nps_monthly(x.model_input))


def _sat_sql(tp: str) -> str:
    w = "monthly_weight"
    weighted = (f"CASE WHEN coalesce(sum(CASE WHEN {tp} IS NOT NULL THEN {w} END), 0) <> 0 THEN "
                f"coalesce(sum(CASE WHEN {tp} >= 8 THEN {w} END), 0) / sum(CASE WHEN {tp} IS NOT NULL THEN {w} END) * 100 "
                f"ELSE 0 END")
    counted = f"CASE WHEN count({tp}) > 0 THEN count_if({tp} >= 8) / count({tp}) * 100 ELSE 0 END"
    return (f"round(CASE WHEN count_if({tp} IS NOT NULL AND {w} IS NOT NULL) > 0 THEN {weighted} "
            f"ELSE {counted} END, 6) AS sat_{tp}")


@register("satisfaction", MODEL + f"""
SELECT {_MONTH} AS flight_month, cabin_in_surveyed_flight, haul,
  {', '.join(_sat_sql(tp) for tp in C.TOUCHPOINTS)}
FROM model_input GROUP BY ALL""")
def q_satisfaction(x: Inputs):
    return rounded(nps.satisfaction_by(x.model_input, [S.month_start(C.DATE).alias("flight_month"), C.CABIN, C.HAUL]))


@register("value_counts", BASE + """
SELECT nps_100, count(*) AS n FROM survey GROUP BY ALL ORDER BY nps_100""")
def q_value_counts(x: Inputs):
    return stats.value_counts(x.survey, C.SCORE)


@register("scalar_stats", MODEL + """
SELECT 'ticket_price' AS column_name, count(ticket_price) AS n, round(min(ticket_price), 6) AS min,
  round(max(ticket_price), 6) AS max, round(avg(ticket_price), 6) AS mean, round(stddev_samp(ticket_price), 6) AS std
FROM model_input
UNION ALL
SELECT 'load_factor', count(load_factor), round(min(load_factor), 6), round(max(load_factor), 6),
  round(avg(load_factor), 6), round(stddev_samp(load_factor), 6) FROM model_input
UNION ALL
SELECT 'nps_100', count(nps_100), round(min(nps_100), 6), round(max(nps_100), 6),
  round(avg(nps_100), 6), round(stddev_samp(nps_100), 6) FROM model_input""")
def q_scalar_stats(x: Inputs):
    return rounded(stats.scalar_stats(x.model_input, ["ticket_price", "load_factor", C.SCORE]))


@register("distinct_segments", MODEL + """
SELECT DISTINCT cabin_in_surveyed_flight, haul FROM model_input""")
def q_distinct_segments(x: Inputs):
    return x.model_input.select(C.CABIN, C.HAUL).distinct()


@register("group_count", MODEL + """
SELECT cabin_in_surveyed_flight, CASE promoter_binary WHEN 1 THEN 'Promoter' ELSE 'Other' END AS label, count(*) AS n
FROM model_input GROUP BY ALL""")
def q_group_count(x: Inputs):
    lab = F.when(F.col(C.PROMOTER) == 1, "Promoter").otherwise("Other")
    return nps.group_count(x.model_input, [C.CABIN, lab.alias("label")])


_DUR = ("(CAST(split_part(time_spent_hrminsec, ':', 1) AS DOUBLE) * 3600 + "
        "CAST(split_part(time_spent_hrminsec, ':', 2) AS DOUBLE) * 60 + "
        "CAST(split_part(time_spent_hrminsec, ':', 3) AS DOUBLE))")


def _mode_sql(c: str) -> str:
    return f"""(SELECT {c} FROM bins b2 WHERE b2.bin IS NOT DISTINCT FROM b.bin AND {c} IS NOT NULL
     GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1) AS mode_{c}"""


@register("binned_mean_mode", BASE + f"""
, bins AS (SELECT CASE WHEN {_DUR} > 0 THEN CAST(ceil({_DUR} / 30) - 1 AS INTEGER) END AS bin,
             pfl_100_checkin, ifl_300_cabin FROM survey)
SELECT bin, round(avg(pfl_100_checkin), 6) AS mean_pfl_100_checkin, {_mode_sql('pfl_100_checkin')},
  round(avg(ifl_300_cabin), 6) AS mean_ifl_300_cabin, {_mode_sql('ifl_300_cabin')}
FROM bins b GROUP BY bin""")
def q_binned_mean_mode(x: Inputs):
    b = S.uniform_bin(S.duration_seconds("time_spent_hrminsec"), 30)
    return rounded(stats.binned_mean_mode(x.survey, b, ["pfl_100_checkin", "ifl_300_cabin"]))


@register("quantiles", MODEL + """
SELECT cabin_in_surveyed_flight, round(quantile_cont(ticket_price, 0.5), 6) AS q_50,
  round(quantile_cont(ticket_price, 0.85), 6) AS q_85
FROM model_input WHERE ticket_price IS NOT NULL GROUP BY ALL""")
def q_quantiles(x: Inputs):
    return rounded(stats.exact_quantiles(x.model_input, "ticket_price", [0.5, 0.85], [C.CABIN]))


_CORR_COLS = ["ticket_price", "load_factor", "pfl_100_checkin", "ifl_300_cabin", "ifl_600_wifi", "nps_100"]


def _corr_sql(k: int | None) -> str:
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
    union = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM model_input"
        for a, b in pairs)
    lim = (f"WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, var_a, var_b LIMIT {k}" if k else "")
    return MODEL + f", c AS ({union})\nSELECT var_a, var_b, round(corr, 6) AS corr FROM c {lim}"


@register("corr_matrix", _corr_sql(None))
def q_corr_matrix(x: Inputs):
    return rounded(stats.corr_pairs(x.model_input, _CORR_COLS))


@register("corr_topk", _corr_sql(5))
def q_corr_topk(x: Inputs):
    return rounded(stats.corr_topk(x.model_input, _CORR_COLS, 5))


_PROF = {"ticket_price": "double", "load_factor": "double", "nps_100": "int", "ifl_600_wifi": "int"}


@register("profile", MODEL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) AS n_rows, count({c}) AS n_non_null, count(DISTINCT {c}) AS n_distinct, "
    f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
    f"round(CAST(max({c}) AS DOUBLE), 6) AS max, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p / 100}), 6) AS q_{p}" for p in (25, 50, 75))
    + " FROM model_input" for c, t in _PROF.items()))
def q_profile(x: Inputs):
    return rounded(stats.profile(x.model_input, list(_PROF)))


_NC = ["delay", "ticket_price", "ifl_600_wifi", "monthly_weight", "invitegroup_ib"]


@register("null_counts", BASE + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS n_null, count({c}) AS n_non_null, "
    f"(SELECT count_if({' OR '.join(f'{d} IS NULL' for d in _NC)}) FROM survey) AS rows_with_any_null FROM survey"
    for c in _NC))
def q_null_counts(x: Inputs):
    return stats.null_counts(x.survey, _NC)


@register("histogram", MODEL + """
, b AS (SELECT min(ticket_price) AS lo, max(ticket_price) AS hi FROM model_input),
h AS (SELECT CASE WHEN b.hi = b.lo THEN 0 ELSE least(29, CAST(floor((ticket_price - b.lo) / ((b.hi - b.lo) / 30.0)) AS INTEGER)) END AS bin
      FROM model_input, b WHERE ticket_price IS NOT NULL)
SELECT bin, round(b.lo + bin * ((b.hi - b.lo) / 30.0), 6) AS bin_lo, round(b.lo + (bin + 1) * ((b.hi - b.lo) / 30.0), 6) AS bin_hi,
  count(*) AS n
FROM h, b GROUP BY bin, b.lo, b.hi""")
def q_histogram(x: Inputs):
    return rounded(stats.histogram(x.model_input, "ticket_price", 30))


@register("binned_count", MODEL + """
SELECT CASE WHEN ifl_300_cabin > 0 AND ifl_300_cabin <= 70 THEN CAST(ceil(ifl_300_cabin / 10) - 1 AS INTEGER) END AS bin,
  cabin_in_surveyed_flight, count(*) AS n
FROM model_input GROUP BY ALL""")
def q_binned_count(x: Inputs):
    m = x.model_input.withColumn("bin", S.cut_right_closed("ifl_300_cabin", [0, 10, 20, 30, 40, 50, 60, 70]))
    return nps.group_count(m, ["bin", C.CABIN])


@register("ols_by_segment", MODEL + """
SELECT cabin_in_surveyed_flight, haul, CAST(regr_count(CAST(nps_100 AS DOUBLE), CAST(pfl_100_checkin AS DOUBLE)) AS BIGINT) AS n,
  round(regr_slope(CAST(nps_100 AS DOUBLE), CAST(pfl_100_checkin AS DOUBLE)), 6) AS slope,
  round(regr_intercept(CAST(nps_100 AS DOUBLE), CAST(pfl_100_checkin AS DOUBLE)), 6) AS intercept,
  round(regr_r2(CAST(nps_100 AS DOUBLE), CAST(pfl_100_checkin AS DOUBLE)), 6) AS r2
FROM model_input GROUP BY ALL""")
def q_ols_by_segment(x: Inputs):
    o = stats.ols(x.model_input, C.SCORE, "pfl_100_checkin", [C.CABIN, C.HAUL])
    return rounded(o.withColumn("n", F.col("n").cast("bigint")))


_CMP = ["nps_100", "pfl_100_checkin", "ifl_300_cabin", "ticket_price"]


@register("sample_compare", MODEL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, "
    f"round(avg(CASE WHEN year(date_flight_local) = 1997 THEN {c} END), 6) AS mean_a, "
    f"round(stddev_samp(CASE WHEN year(date_flight_local) = 1997 THEN {c} END), 6) AS std_a, "
    f"round(avg(CASE WHEN year(date_flight_local) = 2000 THEN {c} END), 6) AS mean_b, "
    f"round(stddev_samp(CASE WHEN year(date_flight_local) = 2000 THEN {c} END), 6) AS std_b, "
    f"round((avg(CASE WHEN year(date_flight_local) = 2000 THEN {c} END) - "
    f"avg(CASE WHEN year(date_flight_local) = 1997 THEN {c} END)) * 100, 6) AS diff FROM model_input"
    for c in _CMP))
def q_sample_compare(x: Inputs):
    m = x.model_input.withColumn("period", F.year(C.DATE))
    return rounded(stats.sample_compare(m, "period", 1997, 2000, _CMP))


# ------------------------------------------------------------------ joins
@register("join_lf_4key", BASE + """
, lf AS (
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS flight_month, l.l_suppkey AS flight,
  CASE l.l_returnflag WHEN 'A' THEN 'Business' WHEN 'N' THEN 'Premium Economy' ELSE 'Economy' END AS cabin,
  CASE l.l_suppkey % 3 WHEN 0 THEN 'LH' WHEN 1 THEN 'SH' ELSE 'MH' END AS haul,
  CASE WHEN l.l_suppkey % 7 = 0 THEN 'I2' WHEN o.o_orderstatus = 'O' THEN 'IB' WHEN o.o_orderstatus = 'F' THEN 'YW' ELSE 'XX' END AS carrier,
  l.l_quantity AS pax, 50 AS capacity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_suppkey % 10 <> 0
),
k5 AS (SELECT flight_month, flight, cabin, haul, carrier, sum(pax) / sum(capacity) AS lf FROM lf GROUP BY ALL),
k4 AS (SELECT flight_month, flight, cabin, carrier, sum(pax) / sum(capacity) AS lf FROM lf GROUP BY ALL),
k3 AS (SELECT flight_month, flight, cabin, sum(pax) / sum(capacity) AS lf FROM lf GROUP BY ALL),
j AS (
SELECT s.haul, CASE WHEN k5.lf IS NOT NULL THEN 5 WHEN k4.lf IS NOT NULL THEN 4 WHEN k3.lf IS NOT NULL THEN 3 END AS match_level,
  coalesce(k5.lf, k4.lf, k3.lf) AS lf
FROM survey s
LEFT JOIN k5 ON k5.flight_month = date_trunc('month', s.date_flight_local) AND k5.flight = s.surveyed_flight_number
  AND k5.cabin = s.cabin_in_surveyed_flight AND k5.haul = s.haul AND k5.carrier = s.operating_airline_code
LEFT JOIN k4 ON k4.flight_month = date_trunc('month', s.date_flight_local) AND k4.flight = s.surveyed_flight_number
  AND k4.cabin = s.cabin_in_surveyed_flight AND k4.carrier = s.operating_airline_code
LEFT JOIN k3 ON k3.flight_month = date_trunc('month', s.date_flight_local) AND k3.flight = s.surveyed_flight_number
  AND k3.cabin = s.cabin_in_surveyed_flight
)
SELECT haul, match_level, count(*) AS n_rows, round(sum(lf), 6) AS lf_sum FROM j GROUP BY ALL""")
def q_join_lf_4key(x: Inputs):
    """Load factor by the most specific of 5, 4 and 3 keys: haul drifts between the sources, carrier codes are renamed."""
    three = ["flight_month", C.FLIGHT, C.CABIN]
    s = x.survey.select(S.month_start(C.DATE).alias("flight_month"), C.FLIGHT, C.CABIN, C.HAUL, C.CARRIER)
    s = nps.group_count(s, [*three, C.HAUL, C.CARRIER])
    j = joins.fallback_join(s, td.load_factor_by_carrier(x.spark, x.sf_dir),
                            [[*three, C.HAUL, C.CARRIER], [*three, C.CARRIER], three], ["pax", "capacity"])
    return j.groupBy(C.HAUL, "match_level").agg(F.sum("n").alias("n_rows"),
                                                r6(F.sum(F.col("n") * S.safe_ratio("pax", "capacity"))).alias("lf_sum"))


@register("join_dictionary", BASE + """
, d AS (SELECT * FROM (VALUES ('ES', ' Spain '), ('FR', 'France'), ('DE', 'GERMANY'), ('US', 'United States'),
                              ('BR', 'Brazil'), ('ZZ', 'unknown')) t(code, country_name))
SELECT lower(trim(d.country_name)) AS country_name, count(*) AS n
FROM survey s LEFT JOIN d ON s.res100_country_code_survey = d.code
WHERE lower(trim(d.country_name)) IS NOT NULL AND lower(trim(d.country_name)) NOT IN ('unknown')
GROUP BY ALL""")
def q_join_dictionary(x: Inputs):
    d = x.spark.createDataFrame([("ES", " Spain "), ("FR", "France"), ("DE", "GERMANY"), ("US", "United States"),
                                 ("BR", "Brazil"), ("ZZ", "unknown")], "code string, country_name string")
    j = joins.join_dictionary(x.survey.select("res100_country_code_survey"), d, "res100_country_code_survey",
                              "code", "country_name", exclude=["unknown"])
    return nps.group_count(j, ["country_name"])


@register("join_segments", SCORED + """
, seg AS (SELECT respondent_id, cabin_in_surveyed_flight AS cabin, haul AS haul_seg FROM survey)
SELECT cabin, haul_seg, count(*) AS n, round(sum(out_prob_nps), 6) AS out_prob_nps_sum
FROM scored_nps s JOIN seg ON s.respondent_id = seg.respondent_id GROUP BY ALL""")
def q_join_segments(x: Inputs):
    seg = x.survey.select(C.ID, F.col(C.CABIN).alias("cabin"), F.col(C.HAUL).alias("haul_seg"))
    j = x.scored.select(C.ID, "out_prob_nps").join(seg, C.ID, "inner")
    return j.groupBy("cabin", "haul_seg").agg(F.count(F.lit(1)).alias("n"),
                                              r6(F.sum("out_prob_nps")).alias("out_prob_nps_sum"))


@register("join_audit", """
WITH a AS (SELECT p_partkey AS k, count(*) AS nl FROM part GROUP BY ALL),
b AS (SELECT l_suppkey AS k, count(*) AS nr FROM lineitem GROUP BY ALL),
j AS (SELECT nl, nr FROM a FULL OUTER JOIN b ON a.k = b.k)
SELECT CASE WHEN nl IS NOT NULL AND nr IS NOT NULL THEN 'both' WHEN nl IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS merge_side,
  CAST(sum(CASE WHEN nl IS NOT NULL AND nr IS NOT NULL THEN nl * nr ELSE coalesce(nl, nr) END) AS BIGINT) AS n_rows,
  count(*) AS n_keys
FROM j GROUP BY ALL""")
def q_join_audit(x: Inputs):
    """Two whole key columns that overlap in part."""
    return joins.join_audit(x.table("part").select(F.col("p_partkey").alias("k")),
                            x.table("lineitem").select(F.col("l_suppkey").alias("k")), ["k"])


@register("key_overlap", """
SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS n_left, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_right,
  (SELECT count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)) AS n_both""")
def q_key_overlap(x: Inputs):
    return joins.key_overlap(x.table("customer").select(F.col("c_custkey").alias("k")),
                             x.table("orders").select(F.col("o_custkey").alias("k")), ["k"])


@register("snapshot_diff", BASE + """
, today AS (SELECT respondent_id, surveyed_flight_number, nps_100, ifl_600_wifi FROM survey WHERE date_flight_local <= DATE '1997-06-30'),
yday AS (SELECT respondent_id, surveyed_flight_number, nps_100, ifl_600_wifi FROM survey WHERE date_flight_local <= DATE '1997-06-29')
SELECT * FROM today t WHERE NOT EXISTS (
  SELECT 1 FROM yday y WHERE t.respondent_id IS NOT DISTINCT FROM y.respondent_id
   AND t.surveyed_flight_number IS NOT DISTINCT FROM y.surveyed_flight_number
   AND t.nps_100 IS NOT DISTINCT FROM y.nps_100 AND t.ifl_600_wifi IS NOT DISTINCT FROM y.ifl_600_wifi)""")
def q_snapshot_diff(x: Inputs):
    cols = [C.ID, C.FLIGHT, C.SCORE, "ifl_600_wifi"]
    today = x.survey.filter(F.col(C.DATE) <= F.lit(dt.date(1997, 6, 30))).select(*cols, C.SNAPSHOT)
    yday = x.survey.filter(F.col(C.DATE) <= F.lit(dt.date(1997, 6, 29))).select(*cols, C.SNAPSHOT)
    return joins.snapshot_diff(today, yday, ignore=[C.SNAPSHOT]).drop(C.SNAPSHOT)


@register("join_fanout", MODEL + """
, l AS (SELECT cabin_in_surveyed_flight, count(*) AS n_left FROM model_input GROUP BY ALL),
r AS (SELECT cabin_in_surveyed_flight, count(*) AS n_right FROM survey GROUP BY ALL)
SELECT count(*) AS n_keys, CAST(sum(n_left * n_right) AS BIGINT) AS n_pairs,
  CAST(max(n_left * n_right) AS BIGINT) AS max_pairs_per_key
FROM l JOIN r USING (cabin_in_surveyed_flight)""")
def q_join_fanout(x: Inputs):
    return joins.join_fanout(x.model_input.select(C.CABIN), x.survey.select(C.CABIN), [C.CABIN])


# ---------------------------------------------------------------- reshape
@register("melt_load_factor", LF_BASE + """
, w AS (SELECT flight_date_local, op_flight_num, pax_business / nullif(capacity_business, 0) AS b,
   pax_premium_ec / nullif(capacity_premium_ec, 0) AS p, pax_economy / nullif(capacity_economy, 0) AS e FROM load_factor)
SELECT flight_date_local, op_flight_num, 'Business' AS cabin_in_surveyed_flight, round(b, 6) AS load_factor FROM w
UNION ALL SELECT flight_date_local, op_flight_num, 'Premium Economy', round(p, 6) FROM w
UNION ALL SELECT flight_date_local, op_flight_num, 'Economy', round(e, 6) FROM w""")
def q_melt_load_factor(x: Inputs):
    lf = reshape.load_factor_ratios(x.load_factor)
    return rounded(reshape.melt_load_factor(lf, keep=["flight_date_local", "op_flight_num"]))


@register("pivot_category", MODEL + f"""
SELECT {_MONTH} AS month, count_if(nps_100 <= 6) AS Detractor, count_if(nps_100 > 6 AND nps_100 <= 8) AS Passive,
  count_if(nps_100 > 8) AS Promoter
FROM model_input GROUP BY ALL""")
def q_pivot_category(x: Inputs):
    m = x.model_input.select(S.month_start(C.DATE).alias("month"), S.nps_category(C.SCORE).alias("cat"))
    return reshape.pivot_counts(m, ["month"], "cat", ["Detractor", "Passive", "Promoter"])


# ---------------------------------------------------------------- windows
@register("pct_change", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY ALL)
SELECT event_type, day, round(v, 6) AS v,
  round(v / nullif(lag(v) OVER (PARTITION BY event_type ORDER BY day), 0) - 1, 6) AS pct_change
FROM d""")
def q_pct_change(x: Inputs):
    ev = x.table("events")
    d = ev.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.avg("value").alias("v"))
    return rounded(windows.pct_change(d, ["event_type"], "day", "v"))


@register("sort_rows", MODEL + """
SELECT respondent_id, date_flight_local FROM model_input ORDER BY respondent_id""")
def q_sort_rows(x: Inputs):
    return x.model_input.select(C.ID, C.DATE).orderBy(C.ID)


@register("head_tail", MODEL + """
(SELECT 'head' AS part, respondent_id, date_flight_local FROM model_input ORDER BY date_flight_local, respondent_id LIMIT 5)
UNION ALL
(SELECT 'tail' AS part, respondent_id, date_flight_local FROM model_input ORDER BY date_flight_local DESC, respondent_id DESC LIMIT 5)""")
def q_head_tail(x: Inputs):
    m = x.model_input.select(C.ID, C.DATE)
    head = m.orderBy(C.DATE, C.ID).limit(5).withColumn("part", F.lit("head"))
    tail = m.orderBy(F.col(C.DATE).desc(), F.col(C.ID).desc()).limit(5).withColumn("part", F.lit("tail"))
    return head.unionByName(tail).select("part", C.ID, C.DATE)


# ---------------------------------------------------------------- set operations
@register("key_intersect", MODEL + """
SELECT surveyed_flight_number FROM (SELECT DISTINCT surveyed_flight_number FROM survey WHERE haul = 'LH')
INTERSECT SELECT DISTINCT surveyed_flight_number FROM survey WHERE haul = 'SH'""")
def q_key_intersect(x: Inputs):
    s = x.survey
    return (s.filter(F.col(C.HAUL) == "LH").select(C.FLIGHT)
            .intersect(s.filter(F.col(C.HAUL) == "SH").select(C.FLIGHT)))


@register("except_rows", MODEL + """
SELECT respondent_id FROM survey EXCEPT ALL SELECT respondent_id FROM model_input""")
def q_except_rows(x: Inputs):
    """Respondents of the whole survey that the cleaning drops."""
    return x.survey.select(C.ID).exceptAll(x.model_input.select(C.ID))
