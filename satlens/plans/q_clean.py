"""Registered queries: filters, projections, renames and casts (inventory §2.2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions import scalar as S
from satlens.operators import clean, joins, nps
from satlens.plans.oracle_base import BASE, MODEL, LOAD_FACTOR, SURVEY, with_ctes
from satlens.plans.registry import Inputs, r6, register, rounded

LF_BASE = with_ctes(SURVEY, LOAD_FACTOR)
_Y = "CAST(year(date_flight_local) AS INTEGER)"


@register("filter_isin", BASE + """
SELECT operating_airline_code, count(*) AS n FROM survey
WHERE operating_airline_code IN ('IB', 'YW') GROUP BY ALL""")
def q_filter_isin(x: Inputs):
    return nps.group_count(clean.filter_isin(x.survey, C.CARRIER, C.ELIGIBLE_CARRIERS), [C.CARRIER])


@register("filter_ne_or_null", BASE + """
SELECT invitegroup_ib, count(*) AS n FROM survey WHERE invitegroup_ib IS DISTINCT FROM 3 GROUP BY ALL""")
def q_filter_ne_or_null(x: Inputs):
    return nps.group_count(x.survey.filter(clean.ne_or_null("invitegroup_ib", 3)), ["invitegroup_ib"])


@register("filter_years", BASE + f"""
SELECT {_Y} AS year, count(*) AS n FROM survey
WHERE date_flight_local >= DATE '1996-01-01' AND year(date_flight_local) NOT IN (1998, 1999)
GROUP BY ALL""")
def q_filter_years(x: Inputs):
    return nps.group_count(clean.filter_years(x.survey), [F.year(C.DATE).alias("year")])


@register("filter_range_closed", BASE + """
SELECT date_flight_local, count(*) AS n FROM survey
WHERE date_flight_local BETWEEN DATE '1997-03-01' AND DATE '1997-03-31' GROUP BY ALL""")
def q_filter_range_closed(x: Inputs):
    d = clean.filter_range(x.survey, C.DATE, dt.date(1997, 3, 1), dt.date(1997, 3, 31), "both")
    return nps.group_count(d, [C.DATE])


@register("filter_range_halfopen", BASE + """
SELECT date_flight_local, count(*) AS n FROM survey
WHERE date_flight_local >= DATE '1997-03-01' AND date_flight_local < DATE '1997-03-31' GROUP BY ALL""")
def q_filter_range_halfopen(x: Inputs):
    d = clean.filter_range(x.survey, C.DATE, dt.date(1997, 3, 1), dt.date(1997, 3, 31), "left")
    return nps.group_count(d, [C.DATE])


@register("filter_quarter", MODEL + f"""
SELECT {_Y} AS year, CAST(month(date_flight_local) AS INTEGER) AS month, count(*) AS n
FROM model_input WHERE quarter(date_flight_local) = 2 GROUP BY ALL""")
def q_filter_quarter(x: Inputs):
    d = clean.filter_quarter(x.model_input, 2)
    return nps.group_count(d, [F.year(C.DATE).alias("year"), F.month(C.DATE).alias("month")])


@register("filter_segment", MODEL + """
SELECT respondent_id, date_flight_local, nps_100 FROM model_input
WHERE cabin_in_surveyed_flight = 'Economy' AND haul = 'SH'""")
def q_filter_segment(x: Inputs):
    return clean.filter_segment(x.model_input, "Economy", "SH").select(C.ID, C.DATE, C.SCORE)


@register("dropna_features", MODEL + """
SELECT cabin_in_surveyed_flight, count(*) AS n FROM model_input
WHERE ticket_price IS NOT NULL AND load_factor IS NOT NULL AND otp15_takeoff IS NOT NULL
  AND pfl_100_checkin IS NOT NULL AND ifl_300_cabin IS NOT NULL AND ifl_600_wifi IS NOT NULL
  AND promoter_binary IS NOT NULL AND detractor_binary IS NOT NULL
GROUP BY ALL""")
def q_dropna_features(x: Inputs):
    d = clean.dropna_features(x.model_input, C.FEATURES + C.LABELS)
    return nps.group_count(d, [C.CABIN])


_DUR = ("(CAST(split_part(time_spent_hrminsec, ':', 1) AS DOUBLE) * 3600 + "
        "CAST(split_part(time_spent_hrminsec, ':', 2) AS DOUBLE) * 60 + "
        "CAST(split_part(time_spent_hrminsec, ':', 3) AS DOUBLE))")


@register("filter_threshold", BASE + f"""
SELECT count_if(delay > 150) AS n_delay_gt_150, count_if(delay >= 0) AS n_delay_ge_0,
  count_if({_DUR} BETWEEN 180 AND 600) AS n_duration_180_600,
  count_if(date_flight_local >= DATE '2000-01-01') AS n_from_2000
FROM survey""")
def q_filter_threshold(x: Inputs):
    s = x.survey.withColumn("__dur", S.duration_seconds("time_spent_hrminsec"))
    return s.agg(F.count_if(F.col("delay") > 150).alias("n_delay_gt_150"),
                 F.count_if(F.col("delay") >= 0).alias("n_delay_ge_0"),
                 F.count_if(F.col("__dur").between(180, 600)).alias("n_duration_180_600"),
                 F.count_if(F.col(C.DATE) >= F.lit(dt.date(2000, 1, 1))).alias("n_from_2000"))


@register("outlier_fence", BASE + """
, b AS (SELECT quantile_cont(ticket_price, 0.05) AS q_lo, quantile_cont(ticket_price, 0.95) AS q_hi FROM survey)
SELECT round(q_lo, 6) AS q_lo, round(q_hi, 6) AS q_hi,
  round(q_lo - 1.5 * (q_hi - q_lo), 6) AS lower, round(q_hi + 1.5 * (q_hi - q_lo), 6) AS upper,
  (SELECT count(*) FROM survey, b b2 WHERE ticket_price BETWEEN b2.q_lo - 1.5 * (b2.q_hi - b2.q_lo)
     AND b2.q_hi + 1.5 * (b2.q_hi - b2.q_lo)) AS n_kept
FROM b""")
def q_outlier_fence(x: Inputs):
    b = clean.outlier_bounds(x.survey, "ticket_price")
    kept = clean.outlier_fence(x.survey, "ticket_price")
    n = kept.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return rounded(b.withColumn("n_kept", n))


@register("filter_month", MODEL + """
SELECT date_flight_local, count(*) AS n FROM model_input
WHERE date_flight_local >= DATE '2000-02-01' AND date_flight_local < DATE '2000-03-01' GROUP BY ALL""")
def q_filter_month(x: Inputs):
    return nps.group_count(clean.filter_month(x.model_input, 2000, 2), [C.DATE])


_PROJ = [C.ID, C.DATE, C.OTP, *C.NUMERIC_FEATURES, *C.TOUCHPOINTS]


@register("project_config", MODEL + f"""
SELECT respondent_id, date_flight_local, otp15_takeoff, round(ticket_price, 6) AS ticket_price,
  round(load_factor, 6) AS load_factor, pfl_100_checkin, ifl_300_cabin, ifl_600_wifi FROM model_input""")
def q_project_config(x: Inputs):
    return rounded(clean.project(x.model_input, _PROJ))


@register("rename_drift", LF_BASE + """
SELECT flight_date_local AS flight_month, op_flight_num AS surveyed_flight_number,
  round(pax_business, 6) AS pax_business, capacity_business, round(pax_premium_ec, 6) AS pax_premium_ec,
  capacity_premium_ec, round(pax_economy, 6) AS pax_economy, capacity_economy
FROM load_factor""")
def q_rename_drift(x: Inputs):
    lf = clean.rename_drift(x.load_factor, {"flight_month": ["flight_date_local"],
                                            C.FLIGHT: ["op_flight_num"],
                                            C.CARRIER: ["operating_carrier", "op_carrier_group_ib"]})
    return rounded(lf.drop(C.HAUL))


@register("drop_cols", MODEL + """
SELECT * EXCLUDE (respondent_id, date_flight_local, monthly_weight, ticket_price, load_factor)
FROM model_input""")
def q_drop_cols(x: Inputs):
    return clean.drop_cols(x.model_input, [C.ID, C.DATE, C.WEIGHT, "ticket_price", "load_factor", "absent_col"])


_SG_COLS = ["cabin_in_surveyed_flight", "haul", "operating_airline_code", "nps_category", "invitegroup",
            "delay", "ticket_price", "nps_100", "pfl_100_checkin", "ifl_600_wifi"]


def _schema_groups_sql() -> str:
    parts = []
    for c in _SG_COLS:
        grp = "categorical" if c in ("cabin_in_surveyed_flight", "haul", "operating_airline_code",
                                     "nps_category") else "numeric"
        parts.append(f"SELECT '{c}' AS column_name, '{grp}' AS column_group, count({c}) AS n_non_null, "
                     f"count(DISTINCT {c}) AS n_distinct FROM survey")
    return BASE + "\nUNION ALL\n".join(parts)


@register("schema_groups", _schema_groups_sql())
def q_schema_groups(x: Inputs):
    s = x.survey.select(*_SG_COLS)
    groups = clean.schema_groups(s)
    kind = {c: g for g, cols in (("categorical", groups["categorical"]), ("numeric", groups["numeric"]))
            for c in cols}
    wide = s.agg(*[F.count(c).alias(f"nn_{c}") for c in _SG_COLS],
                 *[F.count_distinct(c).alias(f"nd_{c}") for c in _SG_COLS])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind[c]).alias("column_group"),
                              F.col(f"nn_{c}").alias("n_non_null"), F.col(f"nd_{c}").alias("n_distinct"))
                     for c in _SG_COLS])
    return wide.select(F.inline(rows))


@register("cast_types", MODEL + """
SELECT respondent_id, TRY_CAST(nps_100 AS SMALLINT) AS nps_100, TRY_CAST(otp15_takeoff AS SMALLINT) AS otp15_takeoff,
  TRY_CAST(ticket_price AS FLOAT) AS ticket_price, TRY_CAST(load_factor AS FLOAT) AS load_factor
FROM model_input""")
def q_cast_types(x: Inputs):
    d = x.model_input.select(C.ID, C.SCORE, C.OTP, "ticket_price", "load_factor")
    return clean.cast_types(d, skip=[C.ID])


@register("cast_keys", LF_BASE + """
, s AS (SELECT CAST(surveyed_flight_number AS DOUBLE) AS k FROM survey),
l AS (SELECT DISTINCT CAST(CAST(op_flight_num AS VARCHAR) AS DOUBLE) AS k FROM load_factor)
SELECT count(*) AS n_matched FROM s JOIN l ON s.k = l.k""")
def q_cast_keys(x: Inputs):
    s = x.survey.select(F.col(C.FLIGHT).cast("double").alias("k"))
    lf = x.load_factor.select(F.col("op_flight_num").cast("string").cast("double").alias("k")).distinct()
    return s.join(lf, "k").agg(F.count(F.lit(1)).alias("n_matched"))


@register("resolve_suffix", MODEL + """
, s AS (SELECT respondent_id, ticket_price, haul FROM survey)
SELECT count(*) AS n_rows, round(sum(coalesce(m.ticket_price, s.ticket_price)), 6) AS price_sum,
  count(coalesce(m.haul, s.haul)) AS n_haul
FROM model_input m JOIN s ON m.respondent_id = s.respondent_id""")
def q_resolve_suffix(x: Inputs):
    m = x.model_input.select(C.ID, "ticket_price", C.HAUL)
    s = x.survey.select(C.ID, "ticket_price", C.HAUL)
    j = joins.resolve_suffix(m, s, [C.ID])
    return j.agg(F.count(F.lit(1)).alias("n_rows"), r6(F.sum("ticket_price")).alias("price_sum"),
                 F.count(C.HAUL).alias("n_haul"))


@register("add_lineage", MODEL + """
SELECT respondent_id, 'linear-v1' AS model_version, date_flight_local AS insert_date_ci FROM model_input""")
def q_add_lineage(x: Inputs):
    return clean.add_lineage(x.model_input, model_version="linear-v1").select(
        C.ID, "model_version", F.col(C.DATE).alias(C.SNAPSHOT))
