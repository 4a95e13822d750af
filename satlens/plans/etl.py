"""Survey + load factor -> model input (the ETL step as one Spark plan).

survey --eligibility, haul relabel, study years, flags--> clean survey
load factor --study years, ratios, melt--> (month, flight, cabin, load_factor)
clean survey --keep first per respondent--> LEFT JOIN load factor (NULL-safe keys, least value a key) --> model input

The load factor side is projected before the melt (the melt triples rows);
the join is a plain equi join that AQE can broadcast once the monthly table is
measured small.  The reference joins first and keeps the first row afterwards, by
the survey's columns and then the load factor: rows that tie on the former have
the same key of the latter, so keeping first before the join gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions.scalar import is_category, late_flag, month_start
from satlens.operators.clean import filter_years, rename_drift, survey_eligible
from satlens.operators.joins import left_join_null_safe
from satlens.operators.reshape import load_factor_ratios, melt_load_factor
from satlens.operators.windows import dedup_first

FLIGHT_MONTH = "flight_month"

# Keep-first order: snapshot fields, then every answer column, NULLs last.
DEDUP_ORDER = [C.DATE, C.FLIGHT, C.CABIN, "delay", "ticket_price", C.SCORE, "pfl_100_checkin",
               "ifl_300_cabin", "ifl_600_wifi", "invitegroup", "load_factor"]

MODEL_COLUMNS = [C.ID, C.DATE, C.CABIN, C.HAUL, C.SCORE, C.WEIGHT, *C.FEATURES, *C.LABELS]


def clean_survey(survey: DataFrame) -> DataFrame:
    s = filter_years(survey_eligible(survey), C.DATE)
    return s.withColumns({
        C.OTP: late_flag(F.col("delay")),
        C.PROMOTER: is_category("nps_category", "Promoter"),
        C.DETRACTOR: is_category("nps_category", "Detractor"),
        FLIGHT_MONTH: month_start(C.DATE),
    })


def clean_load_factor(lf: DataFrame, least: bool = False) -> DataFrame:
    """Study years, pax/capacity ratios, key renames, melt to one row per cabin; ``least``: of several rows a key, the least ratios."""
    lf = filter_years(lf, "flight_date_local")
    lf = load_factor_ratios(lf)
    lf = rename_drift(lf, {FLIGHT_MONTH: ["flight_date_local"], C.FLIGHT: ["op_flight_num"],
                           C.CARRIER: ["operating_carrier", "op_carrier_group_ib"]})
    if least:
        lf = lf.groupBy(FLIGHT_MONTH, C.FLIGHT).agg(*[F.min(c).alias(c) for c in (f"load_factor_{s}" for s in C.CABIN_LF.values())])
    return melt_load_factor(lf, keep=[FLIGHT_MONTH, C.FLIGHT])


def join_load_factor(survey_clean: DataFrame, lf_long: DataFrame,
                     keys: Sequence[str] = (FLIGHT_MONTH, C.FLIGHT, C.CABIN)) -> DataFrame:
    return left_join_null_safe(survey_clean, lf_long, list(keys))


def model_input(survey: DataFrame, lf: DataFrame, columns: Sequence[str] = MODEL_COLUMNS, within: Sequence[str] = ()) -> DataFrame:
    """``within``: columns that all rows of a respondent share; a survey that is dealt by them is not shuffled to keep the first."""
    first = dedup_first(clean_survey(survey), [*within, C.ID], [c for c in DEDUP_ORDER if c != "load_factor"])
    return join_load_factor(first, clean_load_factor(lf, least=True)).select(*columns)
