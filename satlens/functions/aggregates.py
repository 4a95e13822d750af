"""Aggregate expressions (usable in any groupBy().agg / window).

All of them are algebraic (sums and counts), so Spark computes them with a
partial aggregate before the shuffle: a hot group costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions.scalar import col_


def promoters(score=C.SCORE) -> Column:
    return F.count_if(col_(score) > C.PROMOTER_ABOVE)


def detractors(score=C.SCORE) -> Column:
    return F.count_if(col_(score) <= C.DETRACTOR_AT_MOST)


def nps(score=C.SCORE, scale: float = 1.0, empty=None) -> Column:
    """(#promoters - #detractors) / #answered.

    Fraction form (scale 1) gives NULL on an empty group; the x100 form of the
    notebooks gives 0 there (pass ``empty=0.0``).
    """
    n = F.count(col_(score))
    v = F.try_divide((promoters(score) - detractors(score)).cast("double"), n.cast("double")) * F.lit(scale)
    return v if empty is None else F.coalesce(v, F.lit(float(empty)))


def weighted_nps(score=C.SCORE, weight=C.WEIGHT, scale: float = 100.0) -> Column:
    """Weighted NPS; 0 when the weight sum is not positive (or missing)."""
    s, w = col_(score), col_(weight)
    pw = F.coalesce(F.sum(F.when(s > C.PROMOTER_ABOVE, w)), F.lit(0.0))
    dw = F.coalesce(F.sum(F.when(s <= C.DETRACTOR_AT_MOST, w)), F.lit(0.0))
    tw = F.sum(w)
    return F.when(tw > 0, (pw - dw) / tw * F.lit(scale)).otherwise(F.lit(0.0))


def satisfaction(tp, weight: str | None = C.WEIGHT, scale: float = 100.0) -> Column:
    """Share of answers >= 8 (x100).

    Weighted when at least one answered row of the group carries a weight,
    else by counts; 0 when nobody answered.  ``weight=None`` forces counts.
    """
    t = col_(tp)
    ok = t >= C.SATISFIED_FROM
    n_ans = F.count(t)
    counted = F.when(n_ans > 0, F.count_if(ok) / n_ans * F.lit(scale)).otherwise(F.lit(0.0))
    if weight is None:
        return counted
    w = col_(weight)
    sw = F.coalesce(F.sum(F.when(ok, w)), F.lit(0.0))
    tw = F.coalesce(F.sum(F.when(t.isNotNull(), w)), F.lit(0.0))
    weighted = F.when(tw != 0, sw / tw * F.lit(scale)).otherwise(F.lit(0.0))
    has_w = F.count_if(t.isNotNull() & w.isNotNull()) > 0
    return F.when(has_w, weighted).otherwise(counted)


def share_equal(c, value, scale: float = 100.0) -> Column:
    """% of non-null values equal to ``value`` (NULL on an empty group)."""
    x = col_(c)
    return F.try_divide(F.count_if(x == F.lit(value)).cast("double"), F.count(x).cast("double")) * F.lit(scale)


def null_count(c) -> Column:
    return F.count_if(col_(c).isNull())
