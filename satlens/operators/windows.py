"""Ordered operators: keep-first dedup, top-k, returns, running sums (§2.6, §2.7).

Keep-first and top-k are written as ``row_number() <= k``; Spark plans these
as a WindowGroupLimit that runs *before* the shuffle (partial, per task) and
again after it, so a hot key ships at most k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(columns: Sequence[str | Column], nulls_last: bool = True) -> list[Column]:
    out = []
    for c in columns:
        if isinstance(c, str):
            c = F.col(c)
            c = c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
        out.append(c)
    return out


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order`` (give a total order for a
    deterministic result; unlike dropDuplicates this is stable)."""
    w = Window.partitionBy(*keys).orderBy(*total_order(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def pct_change(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "pct_change",
               fill_forward: bool = True) -> DataFrame:
    """x / previous x - 1 within each key, NULL for the first row; with
    ``fill_forward`` a missing value takes the last known one (pandas default)."""
    w = Window.partitionBy(*keys).orderBy(order)
    x = F.col(value)
    if fill_forward:
        x = F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    tmp = df.withColumn("__x", x)
    prev = F.lag("__x").over(w)
    return tmp.withColumn(out, F.try_divide(F.col("__x"), prev) - 1).drop("__x")
