"""Registered queries: scalar functions (inventory §2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions import scalar as S
from satlens.operators import nps
from satlens.plans import etl
from satlens.plans.oracle_base import BASE, MODEL, LOAD_FACTOR, SURVEY, SURVEY_CLEAN, with_ctes
from satlens.plans.registry import Inputs, r6, register, rounded
from satlens.sources.testdata import ISSUE_RULES

_TS = "'%Y%m%d %H:%M:%S'"


@register("haul_merge", BASE + """
SELECT CASE WHEN haul = 'MH' THEN 'SH' ELSE haul END AS haul, count(*) AS n FROM survey GROUP BY ALL""")
def q_haul_merge(x: Inputs):
    return nps.group_count(x.survey.withColumn(C.HAUL, S.haul_merge()), [C.HAUL])


@register("parse_dates", BASE + f"""
SELECT respondent_id,
  try_strptime(scheduled_departure_time_local, {_TS}) AS scheduled_ts,
  try_strptime(real_departure_time_local, {_TS}) AS real_ts,
  (try_strptime(real_departure_time_local, {_TS}) IS NOT NULL OR real_departure_time_local IS NULL) AS real_parsed
FROM survey""")
def q_parse_dates(x: Inputs):
    return x.survey.select(
        C.ID,
        S.parse_timestamp("scheduled_departure_time_local").alias("scheduled_ts"),
        S.parse_timestamp("real_departure_time_local").alias("real_ts"),
        S.parse_ok("real_departure_time_local").alias("real_parsed"))


@register("delay_minutes", BASE + f"""
SELECT respondent_id,
  date_diff('second', try_strptime(scheduled_departure_time_local, {_TS}),
            try_strptime(real_departure_time_local, {_TS})) / 60.0 AS delay_departure
FROM survey""")
def q_delay_minutes(x: Inputs):
    return x.survey.select(C.ID, S.delay_minutes(S.parse_timestamp("real_departure_time_local"),
                                                 S.parse_timestamp("scheduled_departure_time_local"))
                           .alias("delay_departure"))


@register("duration_secs", BASE + """
SELECT respondent_id,
  CAST(split_part(time_spent_hrminsec, ':', 1) AS DOUBLE) * 3600
  + CAST(split_part(time_spent_hrminsec, ':', 2) AS DOUBLE) * 60
  + CAST(split_part(time_spent_hrminsec, ':', 3) AS DOUBLE) AS time_spent_secs
FROM survey""")
def q_duration_secs(x: Inputs):
    return x.survey.select(C.ID, S.duration_seconds("time_spent_hrminsec").alias("time_spent_secs"))


@register("date_parts", BASE + f"""
SELECT DISTINCT date_flight_local, CAST(year(date_flight_local) AS INTEGER) AS year,
  CAST(month(date_flight_local) AS INTEGER) AS month, CAST(day(date_flight_local) AS INTEGER) AS day,
  CAST(isodow(date_flight_local) - 1 AS INTEGER) AS weekday,
  CAST(isodow(date_flight_local) >= 6 AS INTEGER) AS weekend,
  CAST(hour(try_strptime(scheduled_departure_time_local, {_TS})) AS INTEGER) AS dep_hour
FROM survey""")
def q_date_parts(x: Inputs):
    d = F.col(C.DATE)
    return x.survey.select(d, F.year(d).alias("year"), F.month(d).alias("month"),
                           F.dayofmonth(d).alias("day"), S.weekday(d).alias("weekday"),
                           S.weekend_flag(d).alias("weekend"),
                           F.hour(S.parse_timestamp("scheduled_departure_time_local")).alias("dep_hour")
                           ).distinct()


@register("month_bounds", BASE + """
SELECT DISTINCT CAST(date_trunc('month', date_flight_local) AS DATE) AS month_start,
  last_day(date_flight_local) AS month_end FROM survey""")
def q_month_bounds(x: Inputs):
    return x.survey.select(S.month_start(C.DATE).alias("month_start"),
                           S.month_end(C.DATE).alias("month_end")).distinct()


@register("date_arith", BASE + """
SELECT DISTINCT date_flight_local, date_flight_local - 1 AS day_before,
  strftime(date_flight_local - 1, '%Y-%m-%d') AS day_before_text,
  strftime(date_flight_local - 1, '%Y') AS y, strftime(date_flight_local - 1, '%m') AS m,
  strftime(date_flight_local - 1, '%d') AS d
FROM survey""")
def q_date_arith(x: Inputs):
    prev = F.date_sub(F.col(C.DATE), 1)
    txt = F.date_format(prev, "yyyy-MM-dd")
    parts = F.split(txt, "-")
    return x.survey.select(C.DATE, prev.alias("day_before"), txt.alias("day_before_text"),
                           parts[0].alias("y"), parts[1].alias("m"), parts[2].alias("d")).distinct()


@register("otp_flag", BASE + """
SELECT delay, CAST(coalesce(delay > 15, false) AS INTEGER) AS otp15_takeoff, count(*) AS n
FROM survey GROUP BY ALL""")
def q_otp_flag(x: Inputs):
    return nps.group_count(x.survey.withColumn(C.OTP, S.late_flag(F.col("delay"))), ["delay", C.OTP])


@register("label_flags", BASE + """
SELECT nps_100, nps_category,
  CASE WHEN nps_category = 'Promoter' THEN 1 ELSE 0 END AS promoter_binary,
  CASE WHEN nps_category = 'Detractor' THEN 1 ELSE 0 END AS detractor_binary,
  CASE WHEN nps_100 > 8 THEN 1 WHEN nps_100 <= 6 THEN -1 WHEN nps_100 IS NOT NULL THEN 0 END AS nps_class,
  count(*) AS n
FROM survey GROUP BY ALL""")
def q_label_flags(x: Inputs):
    s = x.survey.withColumns({C.PROMOTER: S.is_category("nps_category", "Promoter"),
                              C.DETRACTOR: S.is_category("nps_category", "Detractor"),
                              "nps_class": S.nps_class(C.SCORE)})
    return nps.group_count(s, [C.SCORE, "nps_category", C.PROMOTER, C.DETRACTOR, "nps_class"])


@register("wifi_journey", BASE + """
SELECT cla_600_wifi_t_f, tvl_journey_reason,
  CAST(coalesce(cla_600_wifi_t_f IN ('Could not get it to work', 'No - I could not get it to work'), false) AS INTEGER) AS wifi_not_working,
  CAST(coalesce(cla_600_wifi_t_f IN ('Yes', 'Yes, but not enough'), false) AS INTEGER) AS wifi_used_success,
  CAST(coalesce(tvl_journey_reason IN ('Business', 'Business/work'), false) AS INTEGER) AS business_trip,
  count(*) AS n
FROM survey GROUP BY ALL""")
def q_wifi_journey(x: Inputs):
    s = x.survey.withColumns({"wifi_not_working": S.in_set("cla_600_wifi_t_f", C.WIFI_FAILED),
                              "wifi_used_success": S.in_set("cla_600_wifi_t_f", C.WIFI_USED),
                              "business_trip": S.in_set("tvl_journey_reason", C.BUSINESS_REASONS)})
    return nps.group_count(s, ["cla_600_wifi_t_f", "tvl_journey_reason", "wifi_not_working",
                               "wifi_used_success", "business_trip"])


# Analogue of the reference's before/after cut on the driver's date range.
CUT = "1997-03-13"


@register("date_indicator", BASE + f"""
SELECT CASE WHEN date_flight_local <= DATE '{CUT}' THEN 0 WHEN date_flight_local > DATE '{CUT}' THEN 1 END
  AS indicator_cut, count(*) AS n
FROM survey GROUP BY ALL""")
def q_date_indicator(x: Inputs):
    return nps.group_count(x.survey.withColumn("indicator_cut", S.date_indicator(C.DATE, CUT)),
                           ["indicator_cut"])


def _group_case(col: str, groups: dict, other: str) -> str:
    resolved = {}
    for g, members in groups.items():
        for m in members:
            resolved[m] = g
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in resolved.items())
    return f"CASE {whens} ELSE '{other}' END"


@register("region_map", BASE + f"""
SELECT res100_country_code_survey, {_group_case('res100_country_code_survey', C.COUNTRY_GROUPS, 'Others')}
  AS country_aggr, count(*) AS n
FROM survey GROUP BY ALL""")
def q_region_map(x: Inputs):
    s = x.survey.withColumn("country_aggr", S.group_by_lists("res100_country_code_survey", C.COUNTRY_GROUPS))
    return nps.group_count(s, ["res100_country_code_survey", "country_aggr"])


# Custom grouping given as a parameter; lists overlap on purpose (later wins).
CUSTOM_REGIONS = {
    "EUROPA": ["ES", "FR", "DE", "GB", "IT", "PT", "NL", "RU", "MA"],
    "AFRICA": ["MA", "DZ"],
    "ASIA": ["CN", "JP", "IN"],
    "AMERICA NORTE": ["US", "CA"],
    "AMERICA CENTRO": ["MX", "CO"],
    "AMERICA SUR": ["BR", "AR", "PE", "CL", "CO"],
    "ORIENTE MEDIO": ["SA", "AE", "IL"],
    "ESPAÑA": ["ES"],
}


@register("region_map_priority", BASE + f"""
SELECT res100_country_code_survey, {_group_case('res100_country_code_survey', CUSTOM_REGIONS, 'Others')}
  AS country_aggr, count(*) AS n
FROM survey GROUP BY ALL""")
def q_region_map_priority(x: Inputs):
    s = x.survey.withColumn("country_aggr", S.group_by_lists("res100_country_code_survey", CUSTOM_REGIONS))
    return nps.group_count(s, ["res100_country_code_survey", "country_aggr"])


def _issue_sql() -> str:
    from satlens.sources.testdata import ISSUE_RULES as R
    flags = ", ".join(f"CAST({n} IS NOT NULL AS INTEGER) AS {n}" for n, _ in R)
    return BASE + f"""
SELECT {flags},
  CAST(iss_checkin_queue IS NOT NULL OR iss_checkin_staff IS NOT NULL AS INTEGER) AS issues_pfl_100_checkin,
  CAST(iss_cabin_dirty IS NOT NULL AS INTEGER) AS issues_ifl_300_cabin,
  CAST(iss_wifi_slow IS NOT NULL AS INTEGER) AS issues_ifl_600_wifi,
  count(*) AS n
FROM survey GROUP BY ALL"""


@register("issue_flags", _issue_sql())
def q_issue_flags(x: Inputs):
    from satlens.operators.features import issue_flags
    from satlens.sources.testdata import issues_dictionary
    s = issue_flags(x.survey, issues_dictionary(x.spark))
    cols = [n for n, _ in ISSUE_RULES] + ["issues_pfl_100_checkin", "issues_ifl_300_cabin", "issues_ifl_600_wifi"]
    return nps.group_count(s, cols)


@register("cut_bins", BASE + """
SELECT CASE WHEN nps_100 > -1 AND nps_100 <= 6 THEN '(-1, 6]' WHEN nps_100 > 6 AND nps_100 <= 8 THEN '(6, 8]'
            WHEN nps_100 > 8 AND nps_100 <= 10 THEN '(8, 10]' END AS score_bin,
  CASE WHEN delay > 0 AND delay <= 70 THEN CAST(ceil(delay / 10) - 1 AS INTEGER) END AS delay_bin,
  count(*) AS n
FROM survey GROUP BY ALL""")
def q_cut_bins(x: Inputs):
    s = x.survey.withColumns({
        "score_bin": S.cut_label(C.SCORE, [-1, 6, 8, 10]),
        "delay_bin": S.cut_right_closed("delay", [0, 10, 20, 30, 40, 50, 60, 70])})
    return nps.group_count(s, ["score_bin", "delay_bin"])


@register("late_penalty", MODEL + """
SELECT otp15_takeoff, round(sum(CASE WHEN otp15_takeoff = 1 THEN pfl_100_checkin / 2.0
                                     ELSE pfl_100_checkin END), 6) AS checkin_adjusted_sum
FROM model_input GROUP BY ALL""")
def q_late_penalty(x: Inputs):
    from satlens.operators.features import late_penalty
    m = late_penalty(x.model_input, "pfl_100_checkin", "checkin_adjusted")
    return m.groupBy(C.OTP).agg(r6(F.sum("checkin_adjusted")).alias("checkin_adjusted_sum"))


_LF_PICK = with_ctes(SURVEY, LOAD_FACTOR, SURVEY_CLEAN) + """
, lf AS (
SELECT flight_date_local AS flight_month, op_flight_num AS surveyed_flight_number,
  pax_business / nullif(capacity_business, 0) AS load_factor_business,
  pax_premium_ec / nullif(capacity_premium_ec, 0) AS load_factor_premium_ec,
  pax_economy / nullif(capacity_economy, 0) AS load_factor_economy
FROM load_factor)
SELECT s.cabin_in_surveyed_flight, count(*) AS n_rows,
  round(sum(CASE s.cabin_in_surveyed_flight WHEN 'Business' THEN load_factor_business
    WHEN 'Premium Economy' THEN load_factor_premium_ec WHEN 'Economy' THEN load_factor_economy END), 6) AS lf_sum
FROM survey_clean s LEFT JOIN lf ON s.flight_month = lf.flight_month
  AND s.surveyed_flight_number = lf.surveyed_flight_number
GROUP BY ALL"""


@register("pick_by_cabin", _LF_PICK)
def q_pick_by_cabin(x: Inputs):
    from satlens.operators.features import pick_by_cabin
    from satlens.operators.reshape import load_factor_ratios
    lf = load_factor_ratios(x.load_factor).withColumnsRenamed(
        {"flight_date_local": etl.FLIGHT_MONTH, "op_flight_num": C.FLIGHT})
    lf = lf.select(etl.FLIGHT_MONTH, C.FLIGHT, *[f"load_factor_{s}" for s in C.CABIN_LF.values()])
    s = etl.clean_survey(x.survey).join(lf, [etl.FLIGHT_MONTH, C.FLIGHT], "left")
    s = pick_by_cabin(s)
    return s.groupBy(C.CABIN).agg(F.count(F.lit(1)).alias("n_rows"), r6(F.sum("load_factor")).alias("lf_sum"))


@register("load_factor_ratio", with_ctes(SURVEY, LOAD_FACTOR) + """
SELECT flight_date_local, op_flight_num,
  round(pax_business / nullif(capacity_business, 0), 6) AS load_factor_business,
  round(pax_premium_ec / nullif(capacity_premium_ec, 0), 6) AS load_factor_premium_ec,
  round(pax_economy / nullif(capacity_economy, 0), 6) AS load_factor_economy
FROM load_factor""")
def q_load_factor_ratio(x: Inputs):
    from satlens.operators.reshape import load_factor_ratios
    lf = load_factor_ratios(x.load_factor)
    return rounded(lf.select("flight_date_local", "op_flight_num", "load_factor_business",
                             "load_factor_premium_ec", "load_factor_economy"))


@register("string_ops", BASE + """
SELECT lower(trim(cla_600_wifi_t_f)) AS wifi_text,
  CAST(CASE WHEN cla_600_wifi_t_f IS NULL THEN 0 ELSE len(string_split(cla_600_wifi_t_f, ' ')) END AS INTEGER) AS n_tokens,
  concat_ws('-', CAST(surveyed_flight_number AS VARCHAR), cabin_in_surveyed_flight) AS flight_key,
  count(*) AS n
FROM survey GROUP BY ALL""")
def q_string_ops(x: Inputs):
    s = x.survey.select(F.lower(F.trim("cla_600_wifi_t_f")).alias("wifi_text"),
                        S.token_count("cla_600_wifi_t_f").alias("n_tokens"),
                        F.concat_ws("-", F.col(C.FLIGHT).cast("string"), F.col(C.CABIN)).alias("flight_key"))
    return nps.group_count(s, ["wifi_text", "n_tokens", "flight_key"])


CABIN_CODE = {"Economy": 0, "Premium Economy": 1, "Business": 2}
PROMOTER_LABEL = {0: "not promoter", 1: "promoter"}


@register("map_lookup", MODEL + """
SELECT CASE cabin_in_surveyed_flight WHEN 'Economy' THEN 0 WHEN 'Premium Economy' THEN 1
            WHEN 'Business' THEN 2 END AS cabin_code,
  CASE promoter_binary WHEN 0 THEN 'not promoter' WHEN 1 THEN 'promoter' END AS promoter_label,
  count(*) AS n
FROM model_input GROUP BY ALL""")
def q_map_lookup(x: Inputs):
    m = x.model_input.select(S.map_lookup(C.CABIN, CABIN_CODE).alias("cabin_code"),
                             S.map_lookup(C.PROMOTER, PROMOTER_LABEL).alias("promoter_label"))
    return nps.group_count(m, ["cabin_code", "promoter_label"])


@register("eq_flag", BASE + """
SELECT CAST(cabin_in_surveyed_flight = 'Business' AS INTEGER) AS is_business, count(*) AS n
FROM survey GROUP BY ALL""")
def q_eq_flag(x: Inputs):
    return nps.group_count(x.survey.withColumn("is_business", (F.col(C.CABIN) == "Business").cast("int")),
                           ["is_business"])


@register("coalesce_ids", BASE + """
SELECT respondent_id, coalesce(ticket_num, ticket_num_orig) AS ticket FROM survey""")
def q_coalesce_ids(x: Inputs):
    return x.survey.select(C.ID, F.coalesce("ticket_num", "ticket_num_orig").alias("ticket"))


@register("inv_logit", BASE + """
SELECT DISTINCT nps_100, round(1.0 / (1.0 + exp(-((nps_100 - 5) / 2.0))), 6) AS p FROM survey""")
def q_inv_logit(x: Inputs):
    return x.survey.select(C.SCORE, r6(S.inv_logit((F.col(C.SCORE) - 5) / F.lit(2.0))).alias("p")).distinct()
