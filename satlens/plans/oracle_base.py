"""Shared SQL CTEs for the DuckDB oracles.

They restate ``satlens.sources.testdata`` and ``satlens.plans.etl`` in plain
SQL (DuckDB dialect), independently of the DataFrame code they check.
"""

from __future__ import annotations

from satlens import config as C
from satlens.sources.testdata import ISSUE_RULES, NATION_COUNTRY

_country = "CASE c.c_nationkey " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(NATION_COUNTRY)) + " END"
_issues = ",\n  ".join(
    f"CASE WHEN l.l_partkey % {m} = 0 THEN 'Y' ELSE NULL END AS {n}" for n, m in ISSUE_RULES)
_score = "CAST(least(10, floor(l.l_quantity / 8) + floor(l.l_discount * 40)) AS INTEGER)"
_hours = "to_hours(CAST(l.l_partkey % 24 AS INTEGER))"

SURVEY = f"""survey AS (
SELECT
  l.l_orderkey * 10 + l.l_linenumber AS respondent_id,
  CAST(o.o_orderdate AS DATE) AS date_flight_local,
  CAST(o.o_orderdate AS DATE) AS insert_date_ci,
  l.l_suppkey AS surveyed_flight_number,
  CASE l.l_returnflag WHEN 'A' THEN 'Business' WHEN 'N' THEN 'Premium Economy' ELSE 'Economy' END AS cabin_in_surveyed_flight,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'LH' WHEN 1 THEN 'SH' ELSE 'MH' END AS haul,
  CASE o.o_orderstatus WHEN 'O' THEN 'IB' WHEN 'F' THEN 'YW' ELSE 'XX' END AS operating_airline_code,
  CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_linenumber = 3 THEN 3 ELSE 1 END AS invitegroup_ib,
  CASE WHEN l.l_partkey % 11 = 0 THEN 1 ELSE 2 END AS invitegroup,
  CASE WHEN l.l_partkey % 17 = 0 THEN NULL ELSE CAST(l.l_partkey % 91 - 30 AS DOUBLE) END AS delay,
  CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE l.l_extendedprice / 100 END AS ticket_price,
  {_score} AS nps_100,
  CASE WHEN {_score} > 8 THEN 'Promoter' WHEN {_score} <= 6 THEN 'Detractor' ELSE 'Passive' END AS nps_category,
  CAST(floor(l.l_quantity / 5) AS INTEGER) AS pfl_100_checkin,
  CAST(round(l.l_discount * 100) AS INTEGER) AS ifl_300_cabin,
  CASE WHEN l.l_tax >= 0.05 THEN NULL ELSE CAST(round(l.l_tax * 200) AS INTEGER) END AS ifl_600_wifi,
  CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE 0.5e0 + (l.l_orderkey % 4) * 0.5e0 END AS monthly_weight,
  {_country} AS res100_country_code_survey,
  strftime(o.o_orderdate + {_hours}, '%Y%m%d %H:%M:%S') AS scheduled_departure_time_local,
  CASE WHEN l.l_partkey % 29 = 0 THEN 'bad'
       ELSE strftime(o.o_orderdate + {_hours} + to_minutes(CAST(l.l_partkey % 91 - 30 AS INTEGER)), '%Y%m%d %H:%M:%S')
  END AS real_departure_time_local,
  printf('%02d:%02d:%02d', CAST(l.l_partkey % 3 AS INTEGER), CAST(l.l_suppkey % 60 AS INTEGER),
         CAST((l.l_linenumber * 7) % 60 AS INTEGER)) AS time_spent_hrminsec,
  CASE l.l_partkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'Could not get it to work'
       WHEN 2 THEN 'Yes, but not enough' ELSE NULL END AS cla_600_wifi_t_f,
  CASE WHEN o.o_orderpriority LIKE '1%' THEN 'Business' WHEN o.o_orderpriority LIKE '2%' THEN 'Business/work'
       ELSE 'Leisure' END AS tvl_journey_reason,
  CASE WHEN l.l_linenumber % 2 = 0 THEN NULL ELSE CAST(l.l_orderkey AS VARCHAR) END AS ticket_num,
  CAST(l.l_partkey AS VARCHAR) AS ticket_num_orig,
  {_issues}
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
)"""

LOAD_FACTOR = """load_factor AS (
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS flight_date_local, l.l_suppkey AS op_flight_num,
  CASE l.l_suppkey % 3 WHEN 0 THEN 'LH' WHEN 1 THEN 'SH' ELSE 'MH' END AS haul,
  sum(CASE WHEN l.l_returnflag = 'A' THEN l.l_quantity ELSE 0.0 END) AS pax_business,
  CAST(sum(CASE WHEN l.l_returnflag = 'A' THEN 50 ELSE 0 END) AS BIGINT) AS capacity_business,
  sum(CASE WHEN l.l_returnflag = 'N' THEN l.l_quantity ELSE 0.0 END) AS pax_premium_ec,
  CAST(sum(CASE WHEN l.l_returnflag = 'N' THEN 50 ELSE 0 END) AS BIGINT) AS capacity_premium_ec,
  sum(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0.0 END) AS pax_economy,
  CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 50 ELSE 0 END) AS BIGINT) AS capacity_economy
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_suppkey % 10 <> 0
GROUP BY 1, 2, 3
)"""

_years = (f"date_flight_local >= DATE '{C.YEAR_FLOOR}-01-01' AND year(date_flight_local) NOT IN "
          f"({', '.join(str(y) for y in C.EXCLUDED_YEARS)})")

SURVEY_CLEAN = f"""survey_clean AS (
SELECT * REPLACE (CASE WHEN haul = 'MH' THEN 'SH' ELSE haul END AS haul),
  CAST(coalesce(delay > 15, false) AS INTEGER) AS otp15_takeoff,
  CASE WHEN nps_category = 'Promoter' THEN 1 ELSE 0 END AS promoter_binary,
  CASE WHEN nps_category = 'Detractor' THEN 1 ELSE 0 END AS detractor_binary,
  CAST(date_trunc('month', date_flight_local) AS DATE) AS flight_month
FROM survey
WHERE operating_airline_code IN ('IB', 'YW') AND invitegroup_ib IS DISTINCT FROM 3 AND invitegroup = 2
  AND {_years}
)"""

LF_LONG = f"""lf_wide AS (
SELECT flight_date_local AS flight_month, op_flight_num AS surveyed_flight_number,
  pax_business / nullif(capacity_business, 0) AS lf_business,
  pax_premium_ec / nullif(capacity_premium_ec, 0) AS lf_premium_ec,
  pax_economy / nullif(capacity_economy, 0) AS lf_economy
FROM load_factor
WHERE {_years.replace('date_flight_local', 'flight_date_local')}
),
lf_long AS (
SELECT flight_month, surveyed_flight_number, 'Business' AS cabin_in_surveyed_flight, lf_business AS load_factor FROM lf_wide
UNION ALL
SELECT flight_month, surveyed_flight_number, 'Premium Economy', lf_premium_ec FROM lf_wide
UNION ALL
SELECT flight_month, surveyed_flight_number, 'Economy', lf_economy FROM lf_wide
)"""

JOINED = """joined AS (
SELECT s.*, f.load_factor
FROM survey_clean s LEFT JOIN lf_long f
  ON s.flight_month IS NOT DISTINCT FROM f.flight_month
 AND s.surveyed_flight_number IS NOT DISTINCT FROM f.surveyed_flight_number
 AND s.cabin_in_surveyed_flight IS NOT DISTINCT FROM f.cabin_in_surveyed_flight
)"""

_order = ", ".join(f"{c} ASC NULLS LAST" for c in [
    "date_flight_local", "surveyed_flight_number", "cabin_in_surveyed_flight", "delay", "ticket_price",
    "nps_100", "pfl_100_checkin", "ifl_300_cabin", "ifl_600_wifi", "invitegroup", "load_factor"])

MODEL_INPUT = f"""model_input AS (
SELECT respondent_id, date_flight_local, cabin_in_surveyed_flight, haul, nps_100, monthly_weight,
  ticket_price, load_factor, otp15_takeoff, pfl_100_checkin, ifl_300_cabin, ifl_600_wifi,
  promoter_binary, detractor_binary
FROM (SELECT *, row_number() OVER (PARTITION BY respondent_id ORDER BY {_order}) AS rn FROM joined)
WHERE rn = 1
)"""

# Deterministic contributions (FIXTURES B3): linear in three touchpoints.
CONTRIB = """xs AS (
SELECT *, CAST(pfl_100_checkin AS DOUBLE) AS x1, CAST(ifl_300_cabin AS DOUBLE) AS x2,
  CAST(coalesce(ifl_600_wifi, 0) AS DOUBLE) AS x3
FROM model_input
),
means AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3 FROM xs),
phi AS (
SELECT xs.*, 0.30e0 * (x1 - m1) AS p1, 0.20e0 * (x2 - m2) AS p2, 0.05e0 * (x3 - m3) AS p3
FROM xs, means
),
contrib AS (
SELECT phi.*,
  -1.0e0 AS base_value_prom, -0.5e0 AS base_value_det,
  1.0e0 / (1.0e0 + exp(-(-1.0e0 + p1 + p2 + p3))) AS out_prob_prom,
  1.0e0 / (1.0e0 + exp(-(-0.5e0 - 0.5e0 * (p1 + p2 + p3)))) AS out_prob_det,
  0.01e0 + (respondent_id % 50) / 1000.0e0 AS uncertainty_prom,
  0.01e0 + (respondent_id % 40) / 1000.0e0 AS uncertainty_det
FROM phi
),
scored AS (
SELECT c.*,
  1.0e0 / (1.0e0 + exp(1.0e0)) AS base_prob_prom,
  1.0e0 / (1.0e0 + exp(0.5e0)) AS base_prob_det,
  (p1 + p2 + p3) AS sum_prom,
  -0.5e0 * (p1 + p2 + p3) AS sum_det
FROM contrib c
),
scored_nps AS (
SELECT *,
  CASE WHEN sum_prom = 0 THEN 0.0e0 ELSE p1 * (out_prob_prom - base_prob_prom) / sum_prom END
  - CASE WHEN sum_det = 0 THEN 0.0e0 ELSE (-0.5e0 * p1) * (out_prob_det - base_prob_det) / sum_det END AS pfl_100_checkin_nps,
  CASE WHEN sum_prom = 0 THEN 0.0e0 ELSE p2 * (out_prob_prom - base_prob_prom) / sum_prom END
  - CASE WHEN sum_det = 0 THEN 0.0e0 ELSE (-0.5e0 * p2) * (out_prob_det - base_prob_det) / sum_det END AS ifl_300_cabin_nps,
  CASE WHEN sum_prom = 0 THEN 0.0e0 ELSE p3 * (out_prob_prom - base_prob_prom) / sum_prom END
  - CASE WHEN sum_det = 0 THEN 0.0e0 ELSE (-0.5e0 * p3) * (out_prob_det - base_prob_det) / sum_det END AS ifl_600_wifi_nps,
  0.0e0 AS ticket_price_nps, 0.0e0 AS load_factor_nps, 0.0e0 AS otp15_takeoff_nps,
  base_prob_prom - base_prob_det AS base_prob_nps,
  out_prob_prom - out_prob_det AS out_prob_nps,
  uncertainty_prom + uncertainty_det AS uncertainty_nps
FROM scored
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(SURVEY)
MODEL = with_ctes(SURVEY, LOAD_FACTOR, SURVEY_CLEAN, LF_LONG, JOINED, MODEL_INPUT)
SCORED = with_ctes(SURVEY, LOAD_FACTOR, SURVEY_CLEAN, LF_LONG, JOINED, MODEL_INPUT, CONTRIB)
