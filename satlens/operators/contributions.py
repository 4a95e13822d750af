"""Per-respondent contributions: linear explanations, logit -> probability
rescale and the promoter - detractor merge (§2.10 M14, M15, M20).

Column-wise and narrow: one projection per step, no shuffles.  Feature means
(for the linear explanation) are scalar subqueries, i.e. one partial
aggregate whose single row is applied as a constant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens.functions.scalar import inv_logit


def _x(col: str, fill: Mapping[str, float] | None) -> Column:
    x = F.col(col).cast("double")
    if fill and col in fill:
        x = F.coalesce(x, F.lit(float(fill[col])))
    return x


def linear_contributions(df: DataFrame, weights: Mapping[str, float], suffix: str,
                         base_value: float | None = None, intercept: float = 0.0,
                         fill: Mapping[str, float] | None = None,
                         features: Sequence[str] | None = None) -> DataFrame:
    """Exact explanation of a linear log-odds model f(x) = b + sum w_j x_j:
    phi_j = w_j (x_j - mean x_j); base = b + sum w_j mean x_j unless a fixed
    ``base_value`` is given.  Features of ``features`` without a weight get 0.

    Adds ``<f><suffix>``, ``base_value<suffix>``, ``out_value<suffix>`` and
    ``out_prob<suffix>``.
    """
    means = df.agg(*[F.avg(_x(f, fill)).alias(f) for f in weights])
    m = {f: means.select(f).scalar() for f in weights}
    cols = {}
    for f in (features or list(weights)):
        if f in weights:
            cols[f"{f}{suffix}"] = F.lit(float(weights[f])) * (_x(f, fill) - m[f])
        else:
            cols[f"{f}{suffix}"] = F.lit(0.0)
    base = (F.lit(float(base_value)) if base_value is not None else
            F.lit(float(intercept)) + sum((F.lit(float(w)) * m[f] for f, w in weights.items()), F.lit(0.0)))
    out = df.withColumns(cols).withColumn(f"base_value{suffix}", base)
    total = sum((F.col(c) for c in cols), F.col(f"base_value{suffix}"))
    return out.withColumns({f"out_value{suffix}": total, f"out_prob{suffix}": inv_logit(total)})


def to_probability(df: DataFrame, features: Sequence[str], suffix: str) -> DataFrame:
    """Rescale log-odds contributions to probability units per row:
    base_prob = sigmoid(base_value); phi_j <- phi_j * (out_prob - base_prob) / sum(phi),
    0 when sum(phi) = 0.  The rescaled values add up to out_prob - base_prob."""
    cols = [F.col(f"{f}{suffix}") for f in features]
    total = sum(cols[1:], cols[0])
    base_prob = inv_logit(F.col(f"base_value{suffix}"))
    tmp = df.withColumns({"__sum": total, f"base_prob{suffix}": base_prob})
    gap = F.col(f"out_prob{suffix}") - F.col(f"base_prob{suffix}")
    factor = F.when(F.col("__sum") == 0, F.lit(0.0)).otherwise(gap / F.col("__sum"))
    return tmp.withColumns({f"{f}{suffix}": F.col(f"{f}{suffix}") * factor for f in features}).drop("__sum")


def nps_merge(df: DataFrame, features: Sequence[str], pos: str = "_prom", neg: str = "_det",
              out: str = "_nps") -> DataFrame:
    """``<name>_nps`` = ``<name>_prom`` - ``<name>_det`` for every feature and for
    base_prob / out_prob; uncertainties add instead of subtracting."""
    cols = {f"{f}{out}": F.col(f"{f}{pos}") - F.col(f"{f}{neg}") for f in features}
    for name in ("base_prob", "out_prob"):
        if f"{name}{pos}" in df.columns and f"{name}{neg}" in df.columns:
            cols[f"{name}{out}"] = F.col(f"{name}{pos}") - F.col(f"{name}{neg}")
    if f"uncertainty{pos}" in df.columns and f"uncertainty{neg}" in df.columns:
        cols[f"uncertainty{out}"] = F.col(f"uncertainty{pos}") + F.col(f"uncertainty{neg}")
    return df.withColumns(cols)
