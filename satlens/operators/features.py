"""Feature derivations that need more than one column (§2.9 C16, C18, C19)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C

def issue_flags(df: DataFrame, dictionary: DataFrame, touchpoint_col: str = "associated_touchpoint",
                issue_col: str = "issue_type_2") -> DataFrame:
    """Each issue column -> 0/1 (raised = non-null); ``issues_<touchpoint>`` = any
    of that touchpoint's issues raised.  Only issues that are columns of ``df``
    count, and of each the distinct touchpoints, so that what names the columns
    of the plan is bounded by the columns there are."""
    named = dictionary.where(F.col(issue_col).isin(list(df.columns)) & F.col(touchpoint_col).isNotNull())
    pairs = named.select(touchpoint_col, issue_col).distinct().collect()
    by_tp: dict[str, list[str]] = {}
    for tp, issue in pairs:
        by_tp.setdefault(tp, []).append(issue)
    issues = sorted({i for _, i in pairs})
    cols = {i: F.col(i).isNotNull().cast("int") for i in issues}
    out = df.withColumns(cols)
    any_cols = {f"issues_{tp}": F.greatest(*[F.col(i) for i in sorted(v)], F.lit(0)) for tp, v in by_tp.items()}
    return out.withColumns(any_cols)


def late_penalty(df: DataFrame, score: str, out: str, late: str = C.OTP, factor: float = 0.5) -> DataFrame:
    """Score scaled by ``factor`` when the flight was late."""
    return df.withColumn(out, F.when(F.col(late) == 1, F.col(score) * F.lit(factor))
                         .otherwise(F.col(score).cast("double")))


def pick_by_cabin(df: DataFrame, cabin_lf: Mapping[str, str] = C.CABIN_LF, out: str = "load_factor") -> DataFrame:
    """Row-wise pick of the cabin's load factor column."""
    expr = None
    for cabin, suffix in cabin_lf.items():
        hit = F.col(C.CABIN) == cabin
        expr = F.when(hit, F.col(f"load_factor_{suffix}")) if expr is None else expr.when(
            hit, F.col(f"load_factor_{suffix}"))
    return df.withColumn(out, expr)
