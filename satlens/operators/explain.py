"""Explanations of NPS per period and segment, their comparison between
periods and their adjustment (§2.5 A7-A8, A28-A29, §2.10 M24-M32).

The explanation table is long: one row per (period, segment..., feature) with
``value`` (mean NPS contribution x100), ``data`` (what the feature looked like:
mean, share or satisfaction rate), ``base_value`` and ``prediction``.  It is
built by ONE grouped aggregate over the scored rows (partial per task), then
unpivoted; there is no loop over days, months or features.

Everything after that works on explanation rows, whose groups hold one row per
feature (a bounded number), so the window sums partitioned by
(period, segment) are small by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions import aggregates as A
from satlens.operators.joins import left_join_null_safe
from satlens.functions.scalar import month_start

PERIOD = "period"
BASE_PERIOD = "base_period"


def data_expr(feature: str, numeric: Sequence[str], binary: Sequence[str], weight: str | None) -> Column:
    """What a feature looked like in the group: mean of numeric features, % of
    0 for the late flag (share on time) / % of 1 for other flags, satisfaction
    rate (x100) for touchpoints."""
    if feature in numeric:
        return F.avg(F.col(feature).cast("double"))
    if feature in binary:
        return A.share_equal(feature, 0 if feature == C.OTP else 1)
    return A.satisfaction(feature, weight)


def explain(scored: DataFrame, period: Column, segment: Sequence[str] = C.SEGMENT,
            features: Sequence[str] = C.FEATURES, numeric: Sequence[str] = C.NUMERIC_FEATURES,
            binary: Sequence[str] = C.BINARY_FEATURES, weight: str | None = C.WEIGHT) -> DataFrame:
    """Explanation rows per (period, segment..., feature)."""
    w = weight if weight and weight in scored.columns else None
    aggs = [(F.avg("base_prob_nps") * 100).alias("base_value"), F.avg("out_prob_nps").alias("prediction_frac"),
            F.count(F.lit(1)).alias("n_rows")]
    for f in features:
        aggs += [(F.avg(f"{f}_nps") * 100).alias(f"v__{f}"), data_expr(f, numeric, binary, w).alias(f"d__{f}")]
    wide = scored.groupBy(period.alias(PERIOD), *segment).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i).alias("position"),
                              F.col(f"v__{f}").alias("value"), F.col(f"d__{f}").alias("data"))
                     for i, f in enumerate(features)])
    return wide.select(PERIOD, *segment, F.inline(rows), "base_value", "prediction_frac",
                       (F.col("prediction_frac") * 100).alias("prediction_pct"), "n_rows")


def explain_monthly(scored: DataFrame, closed: str = "both", **kw) -> DataFrame:
    """Monthly explanation.  ``closed='both'`` uses whole months; ``'left'``
    mirrors the notebook's [first day, last day) windows, which leave out the
    last day of every month."""
    if closed == "left":
        scored = scored.filter(F.col(C.DATE) < F.last_day(F.col(C.DATE)))
    return explain(scored, month_start(C.DATE), **kw)


def explain_daily(scored: DataFrame, **kw) -> DataFrame:
    return explain(scored, F.col(C.DATE), **kw)


def calendar_fill(expl: DataFrame, start, end, segment: Sequence[str] = C.SEGMENT,
                  features: Sequence[str] = C.FEATURES) -> DataFrame:
    """Daily explanation with a row for every day of [start, end] and every
    segment present, like a day-by-day loop: days without answers get NULL
    values.  The calendar is generated per segment (days x segments x
    features rows, bounded by the parameters), then left-joined."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY")))
    feats = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i).alias("position"))
                      for i, f in enumerate(features)])
    cal = (expl.select(*segment).distinct().select(*segment, days.alias(PERIOD))
           .select(PERIOD, *segment, F.inline(feats)))
    keys = [PERIOD, *segment, "feature", "position"]
    return left_join_null_safe(cal, expl, keys)


def group_keys(expl: DataFrame, segment: Sequence[str] = C.SEGMENT) -> list[str]:
    keys = [PERIOD] + ([BASE_PERIOD] if BASE_PERIOD in expl.columns else [])
    return keys + list(segment)


def base_year_expr(year: Column, excluded: Sequence[int] = C.EXCLUDED_YEARS) -> Column:
    """Previous comparable year: year - 1, stepping back over excluded years."""
    b = year - 1
    for _ in excluded:
        b = F.when(b.isin(list(excluded)), b - 1).otherwise(b)
    return b


def uplift(current: DataFrame, previous: DataFrame, on: Sequence[str],
           segment: Sequence[str] = C.SEGMENT) -> DataFrame:
    """Change from ``previous`` to ``current`` explanation rows matched on
    ``on`` (segment + feature + period mapping):
    value = current - previous, data = current - previous,
    base = previous base + sum of previous values of its (period, segment)."""
    pk = [PERIOD, *segment]
    p = previous.select(*[F.col(c).alias(f"p__{c}") for c in previous.columns]).withColumn(
        "p__sum", F.sum("p__value").over(Window.partitionBy(*[f"p__{c}" for c in pk])))
    cond = None
    for lc, rc in on:
        period = rc == PERIOD  # segments and features match NULL with NULL, a missing period nothing
        e = F.col(lc) == F.col(f"p__{rc}") if period else F.col(lc).eqNullSafe(F.col(f"p__{rc}"))
        cond = e if cond is None else cond & e
    j = current.join(p, cond, "inner")
    return j.select(
        F.col(PERIOD), F.col(f"p__{PERIOD}").alias(BASE_PERIOD), *segment, "feature", "position",
        (F.col("value") - F.col("p__value")).alias("value"),
        (F.col("data") - F.col("p__data")).alias("data"),
        (F.col("p__base_value") + F.col("p__sum")).alias("base_value"),
        (F.col("prediction_pct") - F.col("p__prediction_pct")).alias("prediction_change"))


def explain_yoy(expl: DataFrame, segment: Sequence[str] = C.SEGMENT,
                excluded: Sequence[int] = C.EXCLUDED_YEARS) -> DataFrame:
    """Each month against the same month of the previous comparable year."""
    cur = expl.withColumn("__bp", F.make_date(base_year_expr(F.year(PERIOD), excluded),
                                              F.month(PERIOD), F.lit(1)))
    on = [("__bp", PERIOD), *[(s, s) for s in segment], ("feature", "feature")]
    return uplift(cur, expl, on, segment)


def explain_vs_base(expl: DataFrame, base_period, segment: Sequence[str] = C.SEGMENT) -> DataFrame:
    """Each period against one fixed base period (e.g. the first month)."""
    cur = expl.withColumn("__bp", F.lit(base_period))
    on = [("__bp", PERIOD), *[(s, s) for s in segment], ("feature", "feature")]
    return uplift(cur, expl, on, segment)


def direction(feature: Column, touchpoints: Sequence[str] = C.TOUCHPOINTS,
              negative_words: Sequence[str] = C.NEGATIVE_DIRECTION_WORDS) -> Column:
    """Expected effect of a feature on NPS: -1 for load factor / price / delay,
    +1 for touchpoints and the late flag, 0 otherwise."""
    neg = None
    for w in negative_words:
        e = feature.contains(w)
        neg = e if neg is None else neg | e
    pos = feature.isin(list(touchpoints) + [C.OTP])
    return F.when(neg, F.lit(-1)).when(pos, F.lit(1)).otherwise(F.lit(0))


def flip_negate(expl: DataFrame, segment: Sequence[str] = C.SEGMENT, flip_when: str = "conflict") -> DataFrame:
    """Sign correction by negation, then rescale to the original total.

    Contributions whose data change is 0 are set to 0.  Then a contribution is
    negated: ``'code'`` - for +1 features when its sign equals the sign of the
    data change, for -1 features when it differs; ``'conflict'`` - when its sign
    contradicts the expected direction (sign(value) = -direction * sign(data)).
    The non-zero-data contributions are finally rescaled so that the group total
    equals the original total (unless they sum to 0)."""
    g = Window.partitionBy(*group_keys(expl, segment))
    d = direction(F.col("feature"))
    sd, v = F.signum("data"), F.when(F.col("data") == 0, F.lit(0.0)).otherwise(F.col("value"))
    sv = F.signum(v)
    if flip_when == "code":
        neg = ((d == 1) & (sd == sv)) | ((d == -1) & (sd != sv))
    elif flip_when == "conflict":
        neg = (sv != 0) & (sv == -d * sd)
    else:
        raise ValueError("flip_when must be 'code' or 'conflict'")
    t = expl.withColumns({"__total": F.sum("value").over(g), "direction": d,
                          "__v": F.when((F.col("data") != 0) & neg, -v).otherwise(v),
                          "flipped": (F.col("data") != 0) & neg})
    t = t.withColumn("__nz", F.sum(F.when(F.col("data") != 0, F.col("__v"))).over(g))
    factor = F.when(F.coalesce(F.col("__nz"), F.lit(0.0)) != 0, F.col("__total") / F.col("__nz")).otherwise(F.lit(1.0))
    return t.withColumn("adjusted", F.when(F.col("data") != 0, F.col("__v") * factor).otherwise(F.col("__v"))) \
        .drop("__total", "__v", "__nz")


def flip_zero_share(expl: DataFrame, segment: Sequence[str] = C.SEGMENT) -> DataFrame:
    """Sign correction by redistribution: a contribution whose sign contradicts
    the expected direction is set to 0 and its value is shared among the
    correctly signed contributions of the same sign, in proportion to their
    absolute value (group total unchanged).  Without such a recipient the
    contribution stays as it is (``unresolved``)."""
    g = Window.partitionBy(*group_keys(expl, segment))
    d = direction(F.col("feature"))
    v, sv, sd = F.col("value"), F.signum("value"), F.signum("data")
    wrong = (sv != 0) & (sv == -d * sd) & (d != 0)
    t = expl.withColumns({"direction": d, "wrong": wrong})
    ok = ~F.col("wrong")
    t = t.withColumns({
        "__wp": F.sum(F.when(F.col("wrong") & (sv > 0), v).otherwise(0.0)).over(g),
        "__wn": F.sum(F.when(F.col("wrong") & (sv < 0), v).otherwise(0.0)).over(g),
        "__rp": F.sum(F.when(ok & (sv > 0), v).otherwise(0.0)).over(g),
        "__rn": F.sum(F.when(ok & (sv < 0), -v).otherwise(0.0)).over(g)})
    wp, wn, rp, rn = F.col("__wp"), F.col("__wn"), F.col("__rp"), F.col("__rn")
    adj = (F.when(F.col("wrong") & (sv > 0), F.when(rp > 0, F.lit(0.0)).otherwise(v))
           .when(F.col("wrong") & (sv < 0), F.when(rn > 0, F.lit(0.0)).otherwise(v))
           .when(sv > 0, v + F.when(rp > 0, wp * v / rp).otherwise(0.0))
           .when(sv < 0, v + F.when(rn > 0, wn * (-v) / rn).otherwise(0.0))
           .otherwise(v))
    unresolved = F.col("wrong") & (((sv > 0) & (rp <= 0)) | ((sv < 0) & (rn <= 0)))
    return t.withColumns({"adjusted": adj, "unresolved": unresolved}).drop("__wp", "__wn", "__rp", "__rn")


def actual_nps(rows: DataFrame, period: Column, segment: Sequence[str] = C.SEGMENT,
               score: str = C.SCORE) -> DataFrame:
    """Observed NPS x100 per period and segment (NULL when nobody answered)."""
    return rows.groupBy(period.alias(PERIOD), *segment).agg(A.nps(score, scale=100.0).alias("actual"))


def adjust_to_actual(expl: DataFrame, actual: DataFrame, segment: Sequence[str] = C.SEGMENT,
                     method: str = "auto", atol: float = 1e-6) -> DataFrame:
    """Rescale contributions so that base + sum = observed NPS.

    ``direct``: every value x (actual - base) / sum (0 when sum = 0).
    ``indirect`` (our reading of the documented approach): with P = sum of
    positive values, N = |sum of negative values| and D = actual - base,
    positives x k and negatives / k where k = (D + sqrt(D^2 + 4PN)) / (2P) -
    the total becomes exactly D while no contribution changes sign; falls back
    to direct when P = 0 or N = 0.  ``auto`` uses indirect only when the
    predicted and the observed change have opposite signs.
    Adds ``adjusted``, ``method_used``, ``error`` (actual - base - sum) and
    ``matches`` (|base + sum(adjusted) - actual| <= atol)."""
    keys = [PERIOD, *segment]
    g = Window.partitionBy(*group_keys(expl, segment))
    t = left_join_null_safe(expl, actual, keys, "inner")
    v = F.col("value")
    t = t.withColumns({"__s": F.sum(v).over(g),
                       "__p": F.sum(F.when(v > 0, v).otherwise(0.0)).over(g),
                       "__n": -F.sum(F.when(v < 0, v).otherwise(0.0)).over(g),
                       "__d": F.col("actual") - F.col("base_value")})
    s, p, n, dlt = F.col("__s"), F.col("__p"), F.col("__n"), F.col("__d")
    direct = v * F.when(s != 0, dlt / s).otherwise(F.lit(0.0))
    k = (dlt + F.sqrt(dlt * dlt + 4 * p * n)) / (2 * p)
    can_indirect = (p > 0) & (n > 0)
    indirect = F.when(v > 0, v * k).otherwise(v / k)
    if method == "direct":
        use_ind = F.lit(False)
    elif method == "indirect":
        use_ind = can_indirect
    elif method == "auto":
        use_ind = can_indirect & (F.signum(s) * F.signum(dlt) < 0)
    else:
        raise ValueError("method must be direct, indirect or auto")
    t = t.withColumns({"method_used": F.when(use_ind, F.lit("indirect")).otherwise(F.lit("direct")),
                       "adjusted": F.when(use_ind, indirect).otherwise(direct),
                       "error": dlt - s})
    t = t.withColumn("matches", F.abs(F.col("base_value") + F.sum("adjusted").over(g) - F.col("actual")) <= atol)
    return t.drop("__s", "__p", "__n", "__d")


def waterfall(adjusted: DataFrame, segment: Sequence[str] = C.SEGMENT, value: str = "value",
              adjusted_col: str = "adjusted") -> DataFrame:
    """Bars of the original vs adjusted explanation: per feature the
    difference, and the running start of each adjusted bar from the base."""
    keys = group_keys(adjusted, segment)
    w = Window.partitionBy(*keys).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base_value") + F.coalesce(F.sum(adjusted_col).over(w), F.lit(0.0))
    return adjusted.select(*keys, "feature", "position", F.col(value).alias("original"),
                           F.col(adjusted_col).alias("adjusted"),
                           (F.col(value) - F.col(adjusted_col)).alias("difference"),
                           start.alias("start"), (start + F.col(adjusted_col)).alias("end"))


def nps_mae(expl: DataFrame, actual: DataFrame, segment: Sequence[str] = C.SEGMENT) -> DataFrame:
    """Mean absolute error of predicted vs observed NPS x100 over periods."""
    per = expl.select(PERIOD, *segment, "prediction_pct").distinct()
    j = left_join_null_safe(per, actual, [PERIOD, *segment], "inner")
    return j.groupBy(*segment).agg(F.count(F.lit(1)).alias("n_periods"),
                                   F.avg(F.abs(F.col("prediction_pct") - F.col("actual"))).alias("mae"))
