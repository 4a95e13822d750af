"""Registered queries: ETL, cleaning and NPS core (sections 2.1-2.5 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import clean, nps
from satlens.plans import etl
from satlens.plans.oracle_base import BASE, MODEL
from satlens.plans.registry import Inputs, r6, register

_MONTH = "CAST(date_trunc('month', date_flight_local) AS DATE)"


# --- flagship: NPS by month x cabin x haul on the model input ---------------
@register("nps_by_segment", MODEL + f"""
SELECT {_MONTH} AS flight_month, cabin_in_surveyed_flight, haul,
  count(nps_100) AS n_answers, count_if(nps_100 > 8) AS promoters, count_if(nps_100 <= 6) AS detractors,
  round((count_if(nps_100 > 8) - count_if(nps_100 <= 6)) / nullif(count(nps_100), 0)::DOUBLE, 6) AS nps
FROM model_input GROUP BY ALL""")
def q_nps_by_segment(x: Inputs):
    return nps.nps_by_month_segment(x.model_input).withColumn("nps", r6("nps"))


@register("model_input_summary", MODEL + """
SELECT count(*) AS n_rows, count(DISTINCT respondent_id) AS n_respondents,
  count(load_factor) AS n_with_lf, round(sum(load_factor), 6) AS lf_sum,
  CAST(sum(otp15_takeoff) AS BIGINT) AS n_late, CAST(sum(promoter_binary) AS BIGINT) AS n_prom, CAST(sum(detractor_binary) AS BIGINT) AS n_det
FROM model_input""")
def q_model_input_summary(x: Inputs):
    m = x.model_input
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(C.ID).alias("n_respondents"),
                 F.count("load_factor").alias("n_with_lf"), r6(F.sum("load_factor")).alias("lf_sum"),
                 F.sum(C.OTP).cast("bigint").alias("n_late"), F.sum(C.PROMOTER).cast("bigint").alias("n_prom"),
                 F.sum(C.DETRACTOR).cast("bigint").alias("n_det"))


@register("dedup_first", MODEL + """
SELECT * REPLACE (round(monthly_weight, 6) AS monthly_weight, round(ticket_price, 6) AS ticket_price,
                  round(load_factor, 6) AS load_factor)
FROM model_input""")
def q_dedup_first(x: Inputs):
    from satlens.plans.registry import rounded
    return rounded(x.model_input)


@register("join_load_factor", MODEL + """
SELECT cabin_in_surveyed_flight, count(*) AS n_rows, count(load_factor) AS n_matched,
  round(sum(load_factor), 6) AS lf_sum
FROM joined GROUP BY ALL""")
def q_join_load_factor(x: Inputs):
    j = etl.join_load_factor(etl.clean_survey(x.survey), etl.clean_load_factor(x.load_factor))
    return j.groupBy(C.CABIN).agg(F.count(F.lit(1)).alias("n_rows"), F.count("load_factor").alias("n_matched"),
                                  r6(F.sum("load_factor")).alias("lf_sum"))


@register("survey_eligible", BASE + """
SELECT CASE WHEN haul = 'MH' THEN 'SH' ELSE haul END AS haul, operating_airline_code, count(*) AS n
FROM survey
WHERE operating_airline_code IN ('IB', 'YW') AND invitegroup_ib IS DISTINCT FROM 3 AND invitegroup = 2
GROUP BY ALL""")
def q_survey_eligible(x: Inputs):
    return nps.group_count(clean.survey_eligible(x.survey), [C.HAUL, C.CARRIER])
