"""NPS / satisfaction aggregates by segment and period (§2.5 A3-A6, A13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions import aggregates as A
from satlens.functions.scalar import month_start


def nps_by(df: DataFrame, group: Sequence, score: str = C.SCORE, scale: float = 1.0) -> DataFrame:
    """Answers, promoters, detractors and NPS (fraction, NULL when empty) per group."""
    return df.groupBy(*group).agg(
        F.count(score).alias("n_answers"),
        A.promoters(score).alias("promoters"),
        A.detractors(score).alias("detractors"),
        A.nps(score, scale=scale).alias("nps"))


def nps_by_month_segment(model_input: DataFrame, segment: Sequence[str] = C.SEGMENT) -> DataFrame:
    return nps_by(model_input, [month_start(C.DATE).alias("flight_month"), *segment])


def weighted_nps_by(df: DataFrame, group: Sequence, score: str = C.SCORE,
                    weight: str = C.WEIGHT) -> DataFrame:
    return df.groupBy(*group).agg(A.weighted_nps(score, weight).alias("nps_weighted"),
                                  F.sum(weight).alias("weight_sum"))


def nps_monthly(df: DataFrame, score: str = C.SCORE, date: str = C.DATE) -> DataFrame:
    """Monthly NPS x100 from binned answers (0-6 / 7-8 / 9-10)."""
    s = F.col(score)
    return df.groupBy(month_start(date).alias("month")).agg(
        F.count_if(s <= 6).alias("detractors"),
        F.count_if((s > 6) & (s <= 8)).alias("passives"),
        F.count_if(s > 8).alias("promoters"),
        F.count(s).alias("n_answers"),
        A.nps(score, scale=100.0, empty=0.0).alias("nps"))


def satisfaction_by(df: DataFrame, group: Sequence, touchpoints: Sequence[str] = C.TOUCHPOINTS,
                    weight: str | None = C.WEIGHT) -> DataFrame:
    """Satisfaction rate (x100) of every touchpoint in one aggregate."""
    w = weight if weight in df.columns else None
    return df.groupBy(*group).agg(*[A.satisfaction(tp, w).alias(f"sat_{tp}") for tp in touchpoints])


def group_count(df: DataFrame, group: Sequence) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
