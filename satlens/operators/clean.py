"""Filters, projections, renames and casts (§2.2).

All of these are narrow transformations: Catalyst folds them into the scan
stage and pushes whatever it can into the Parquet reader.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlens import config as C
from satlens.functions.scalar import col_, haul_merge


def filter_isin(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def ne_or_null(column, value) -> Column:
    """``column != value`` where a NULL counts as 'not equal' (pandas semantics)."""
    return ~col_(column).eqNullSafe(F.lit(value))


def eligible_condition(carriers=C.ELIGIBLE_CARRIERS, excluded_ib=C.EXCLUDED_INVITEGROUP_IB,
                       kept_group=C.KEPT_INVITEGROUP) -> Column:
    return (F.col(C.CARRIER).isin(list(carriers))
            & ne_or_null("invitegroup_ib", excluded_ib)
            & (F.col("invitegroup") == kept_group))


def survey_eligible(df: DataFrame, **kw) -> DataFrame:
    """Carrier / invite-group eligibility of survey answers, plus haul relabel."""
    return df.withColumn(C.HAUL, haul_merge(C.HAUL)).filter(eligible_condition(**kw))


def year_condition(column: str, floor: int = C.YEAR_FLOOR, excluded=C.EXCLUDED_YEARS) -> Column:
    """year >= floor and year not excluded, written as date ranges (pushable)."""
    d = F.col(column)
    cond = d >= F.lit(_dt.date(floor, 1, 1))
    for y in excluded:
        cond = cond & ~((d >= F.lit(_dt.date(y, 1, 1))) & (d < F.lit(_dt.date(y + 1, 1, 1))))
    return cond


def filter_years(df: DataFrame, column: str = C.DATE, floor: int = C.YEAR_FLOOR,
                 excluded=C.EXCLUDED_YEARS) -> DataFrame:
    return df.filter(year_condition(column, floor, excluded))


def filter_range(df: DataFrame, column: str, lo, hi, closed: str = "both") -> DataFrame:
    """Date/number range; ``closed`` is 'both' ([lo, hi]) or 'left' ([lo, hi))."""
    c = F.col(column)
    upper = c <= F.lit(hi) if closed == "both" else c < F.lit(hi)
    return df.filter((c >= F.lit(lo)) & upper)


def filter_quarter(df: DataFrame, quarter: int, column: str = C.DATE) -> DataFrame:
    """Rows whose date falls in calendar quarter 1..4 of any year."""
    return df.filter(F.quarter(F.col(column)) == quarter)


def filter_month(df: DataFrame, year: int, month: int, column: str = C.DATE) -> DataFrame:
    start = _dt.date(year, month, 1)
    end = _dt.date(year + (month == 12), month % 12 + 1, 1)
    return filter_range(df, column, start, end, closed="left")


def filter_segment(df: DataFrame, cabin: str | None = None, haul: str | None = None) -> DataFrame:
    cond = F.lit(True)
    if cabin is not None:
        cond = cond & (F.col(C.CABIN) == cabin)
    if haul is not None:
        cond = cond & (F.col(C.HAUL) == haul)
    return df.filter(cond)


def dropna_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Complete cases on the given columns (NaN counts as missing)."""
    cond = F.lit(True)
    for c in columns:
        x = F.col(c)
        miss = x.isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(x)
        cond = cond & ~miss
    return df.filter(cond)


def outlier_bounds(df: DataFrame, column: str, lo_q: float = 0.05, hi_q: float = 0.95,
                   k: float = 1.5) -> DataFrame:
    """One-row table of exact quantile fences q_lo - k*IQR, q_hi + k*IQR
    (bounded-memory exact quantiles, see ``stats.exact_quantiles``)."""
    from satlens.operators.stats import exact_quantiles
    q = exact_quantiles(df, column, [lo_q, hi_q], prefix="__q")
    a, b = q.columns
    return (q.select(F.col(a).alias("q_lo"), F.col(b).alias("q_hi"))
            .select("q_lo", "q_hi",
                (F.col("q_lo") - F.lit(k) * (F.col("q_hi") - F.col("q_lo"))).alias("lower"),
                (F.col("q_hi") + F.lit(k) * (F.col("q_hi") - F.col("q_lo"))).alias("upper")))


def outlier_fence(df: DataFrame, column: str, lo_q: float = 0.05, hi_q: float = 0.95,
                  k: float = 1.5) -> DataFrame:
    """Keep rows inside the fences.  The bounds are scalar subqueries: computed
    once by one aggregate (partial per task) and applied as constants."""
    b = outlier_bounds(df, column, lo_q, hi_q, k)
    lower = b.select("lower").scalar()
    upper = b.select("upper").scalar()
    return df.filter((F.col(column) >= lower) & (F.col(column) <= upper))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_drift(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename to a canonical name from whichever candidate column exists."""
    present = set(df.columns)
    renames = {}
    for new, olds in candidates.items():
        for old in olds:
            if old in present:
                renames[old] = new
                break
    return df.withColumnsRenamed(renames) if renames else df


def drop_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def schema_groups(df: DataFrame) -> dict[str, list[str]]:
    """Split columns into categorical (string/bool) and numeric by type."""
    cat, num = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BooleanType)):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return {"categorical": cat, "numeric": num}


def cast_types(df: DataFrame, int_to: str = "smallint", float_to: str = "float",
               skip: Sequence[str] = ()) -> DataFrame:
    """Downcast the integer and double columns whose values all fit; the others
    keep their type, so that no value is lost.  One aggregate decides them all;
    a column without values fits."""
    ranges = {"tinyint": 2**7, "smallint": 2**15, "int": 2**31, "bigint": 2**63}
    wide = [f for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, (T.LongType, T.IntegerType, T.DoubleType))]
    checks = []
    for f in wide:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            finite = ~F.isnan(c) & (F.abs(c) != float("inf"))
            bad = finite & (F.abs(c) > 3.4028234663852886e38) & F.lit(float_to == "float")
        else:
            top = ranges[int_to]
            bad = (c < F.lit(-top).cast("decimal(20,0)")) | (c >= F.lit(top).cast("decimal(20,0)"))
        checks.append(F.coalesce(F.max(bad), F.lit(False)).alias(f.name))
    row = df.agg(*checks).first() if checks else {}
    skip = [*skip, *(f.name for f in wide if row[f.name])]
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            exprs.append(c)
        elif isinstance(f.dataType, (T.LongType, T.IntegerType)):
            exprs.append(c.cast(int_to).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            exprs.append(c.cast(float_to).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def add_lineage(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})
