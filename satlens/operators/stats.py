"""Descriptive statistics (§2.5 A9-A21, A25, A28).

Everything is one aggregate (partial per task, merged after the shuffle) or a
window over already-aggregated rows.  Exact quantiles never hold a group's
values in memory: they count rows per distinct value, take running counts in
value order (a spillable sort) and interpolate between the two ranks around
each requested position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlens.operators.joins import left_join_null_safe
_MANT = 1 << 20


def order_keys(v: Column) -> tuple[Column, Column, Column]:
    """Three integer keys whose lexicographic order is the order of the double
    ``v``: (sign and binary exponent, next 20 mantissa bits, next 20 bits).
    Dividing by an exact power of two keeps every step exact."""
    a = F.abs(v)
    e0 = F.floor(F.log2(a)).cast("int")
    e = (F.when(F.pow(F.lit(2.0), e0) > a, e0 - 1)
         .when(F.pow(F.lit(2.0), e0 + 1) <= a, e0 + 1).otherwise(e0))
    m = (a / F.pow(F.lit(2.0), e) - 1) * _MANT          # [0, 2^20)
    f1 = F.floor(m)
    f2 = F.floor((m - f1) * _MANT)
    pos, neg = v > 0, v < 0
    k1 = F.when(pos, 3_000_000 + e).when(neg, 1_000_000 - e).otherwise(2_000_000).cast("long")
    k2 = F.when(pos, f1).when(neg, _MANT - 1 - f1).otherwise(0).cast("long")
    k3 = F.when(pos, f2).when(neg, _MANT - 1 - f2).otherwise(0).cast("long")
    return k1, k2, k3


def value_prefix_sums(df: DataFrame, value: Column, sums: dict[str, Column], group: Sequence[str] = ()) -> DataFrame:
    """Per distinct (group, value): each sum at that value (``<name>``) and over
    all strictly smaller values (``<name>_below``) - a prefix sum in value
    order without sorting a whole group in one task.

    Distinct values are bucketed by ``order_keys``; each level's offsets come
    from a window over one parent bucket (at most ~4200 exponents, then 2^20
    sub-buckets twice), and the last window orders the values inside one
    finest bucket (at most 4096 distinct doubles).  NULL and NaN are skipped.
    """
    group = list(group)
    v = value.cast("double")
    per = (df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*group, v.alias("__v"))
           .agg(*[e.alias(n) for n, e in sums.items()]))
    k1, k2, k3 = order_keys(F.col("__v"))
    per = per.withColumns({"__k1": k1, "__k2": k2, "__k3": k3})
    names = list(sums)
    levels = [["__k1"], ["__k1", "__k2"], ["__k1", "__k2", "__k3"]]
    out = per
    for i, keys in enumerate(levels):
        parent, last = group + keys[:-1], keys[-1]
        t = per.groupBy(*group, *keys).agg(*[F.sum(n).alias(n) for n in names])
        w = Window.partitionBy(*parent).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
        cols = [F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"__o{i}_{n}") for n in names]
        if i == 0:  # group totals ride along with the first level (small table)
            cols += [F.sum(n).over(Window.partitionBy(*group)).alias(f"{n}_total") for n in names]
        out = left_join_null_safe(out, t.select(*group, *keys, *cols), group + keys, "inner")
    wf = Window.partitionBy(*group, "__k1", "__k2", "__k3").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    below = {f"{n}_below": (F.col(f"__o0_{n}") + F.col(f"__o1_{n}") + F.col(f"__o2_{n}")
                            + F.coalesce(F.sum(n).over(wf), F.lit(0))) for n in names}
    return out.withColumns(below).select(*group, F.col("__v").alias("value"), *names, *below,
                                         *[f"{n}_total" for n in names])


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], group: Sequence[str] = (),
                    prefix: str = "q") -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / quantile_cont
    convention): position h = (n - 1) p between the order statistics.

    One output row per group with ``<prefix>_<p*100>`` columns.  Ranks come
    from ``value_prefix_sums`` (bounded windows), not from sorting a group.
    """
    group = list(group)
    pre = value_prefix_sums(df, F.col(column), {"__c": F.count(F.lit(1))}, group)
    ranked = pre.select(*group, F.col("value").alias("__v"), "__c", F.col("__c_total").alias("__n"),
                           F.col("__c_below").alias("__lo"), (F.col("__c_below") + F.col("__c")).alias("__hi"))
    # Each requested probability needs the values at ranks floor(h) and ceil(h).
    probs = [float(p) for p in probs]
    out_cols = []
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1) * F.lit(p)
        lo_r, hi_r = F.floor(h), F.ceil(h)
        frac = h - lo_r
        at_lo = (F.col("__lo") <= lo_r) & (lo_r < F.col("__hi"))
        at_hi = (F.col("__lo") <= hi_r) & (hi_r < F.col("__hi"))
        ranked = ranked.withColumns({f"__a{i}": F.when(at_lo, F.col("__v")),
                                     f"__b{i}": F.when(at_hi, F.col("__v")),
                                     f"__f{i}": frac})
        aggs += [F.max(f"__a{i}").alias(f"__a{i}"), F.max(f"__b{i}").alias(f"__b{i}"),
                 F.max(f"__f{i}").alias(f"__f{i}")]
        name = f"{prefix}_{_pct(p)}"
        out_cols.append((F.col(f"__a{i}") + F.col(f"__f{i}") * (F.col(f"__b{i}") - F.col(f"__a{i}"))).alias(name))
    hits = [F.col(f"__a{i}").isNotNull() | F.col(f"__b{i}").isNotNull() for i in range(len(probs))]
    keep = ranked.filter(F.greatest(*hits) if len(hits) > 1 else hits[0])
    res = keep.groupBy(*group).agg(*aggs)
    return res.select(*group, *out_cols)


def _pct(p: float) -> str:
    s = f"{p * 100:g}"
    return s.replace(".", "_")


def scalar_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min / max / mean / sample std per column, long form."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}"),
                 F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"), F.count(c).alias(f"n_{c}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("n"),
                              F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max"),
                              F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"))
                     for c in columns])
    return wide.select(F.inline(rows))


def corr_pairs(df: DataFrame, columns: Sequence[str], both: bool = False) -> DataFrame:
    """Pearson correlation of every pair i < j over pairwise-complete rows,
    computed in one aggregate; ``both`` mirrors each pair (a, b) and (b, a)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    structs = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"{a}__{b}").alias("corr"))
               for a, b in pairs]
    if both:
        structs += [F.struct(F.lit(b).alias("var_a"), F.lit(a).alias("var_b"), F.col(f"{a}__{b}").alias("corr"))
                    for a, b in pairs]
    return wide.select(F.inline(F.array(*structs)))


def corr_topk(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k most correlated pairs by |corr| (ties by names)."""
    c = corr_pairs(df, columns)
    return (c.filter(F.col("corr").isNotNull())
            .orderBy(F.abs("corr").desc(), "var_a", "var_b").limit(k))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: non-null and null counts; plus the rows having any null."""
    columns = list(columns or df.columns)
    any_null = F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), F.count_if(any_null).alias("__any"),
                  *[F.count_if(F.col(c).isNull()).alias(f"nul_{c}") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"nul_{c}").alias("n_null"),
                              (F.col("__rows") - F.col(f"nul_{c}")).alias("n_non_null"),
                              F.col("__any").alias("rows_with_any_null"))
                     for c in columns])
    return wide.select(F.inline(rows))


def profile(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """describe()-like profile: type, rows, non-null, distinct, mean, std, min,
    max and quartiles (numeric columns as double).  The plain statistics are one
    aggregate; distinct counts and quantiles are a scalar subquery a column, so
    that no row is expanded once per column before a shuffle."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in columns:
        aggs += [F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"),
                 F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}")]
    wide = df.agg(*aggs)
    names = [f"q_{_pct(float(p))}" for p in probs]
    rows = []
    for c in columns:
        distinct = df.select(F.col(c)).agg(F.count_distinct(c).alias("d")).select("d").scalar()
        at = exact_quantiles(df, c, list(probs)).select(F.struct(*names)).scalar()
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                             F.col("__rows").alias("n_rows"), F.col(f"n_{c}").alias("n_non_null"), distinct.alias("n_distinct"),
                             F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"),
                             F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max"), *(at.getField(n).alias(n) for n in names)))
    return wide.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed), like numpy.
    min / max are scalar subqueries (one partial aggregate)."""
    x = F.col(column).cast("double")
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((x - lo) / width).cast("int")))
    out = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def binned_mean_mode(df: DataFrame, bin_col: Column, columns: Sequence[str]) -> DataFrame:
    """Mean and mode (smallest value on ties) of each column per bin."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.mode(F.col(c), deterministic=True).alias(f"mode_{c}")]
    return df.groupBy(bin_col.alias("bin")).agg(*aggs)


def ols(df: DataFrame, y: str, x: str, group: Sequence[str] = ()) -> DataFrame:
    """Univariate least squares y ~ x per group on rows where both are present."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*group).agg(F.regr_count(yy, xx).alias("n"), F.regr_slope(yy, xx).alias("slope"),
                                  F.regr_intercept(yy, xx).alias("intercept"), F.regr_r2(yy, xx).alias("r2"))


def sample_compare(df: DataFrame, period_col: str, a, b, columns: Sequence[str], scale: float = 100.0) -> DataFrame:
    """Mean and std of each column in two samples and the difference of means
    (b - a) x scale; one aggregate with conditional expressions."""
    p = F.col(period_col)
    aggs = []
    for c in columns:
        for tag, v in (("a", a), ("b", b)):
            aggs += [F.avg(F.when(p == F.lit(v), F.col(c))).alias(f"{tag}_mean_{c}"),
                     F.stddev_samp(F.when(p == F.lit(v), F.col(c))).alias(f"{tag}_std_{c}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"a_mean_{c}").alias("mean_a"),
                              F.col(f"a_std_{c}").alias("std_a"), F.col(f"b_mean_{c}").alias("mean_b"),
                              F.col(f"b_std_{c}").alias("std_b"),
                              ((F.col(f"b_mean_{c}") - F.col(f"a_mean_{c}")) * F.lit(scale)).alias("diff"))
                     for c in columns])
    return wide.select(F.inline(rows))


def global_importance(scored: DataFrame, features: Sequence[str], suffixes=("_prom", "_det", "_nps")) -> DataFrame:
    """Mean |contribution| and mean contribution per feature and model."""
    aggs = []
    for f in features:
        for s in suffixes:
            aggs += [F.avg(F.abs(F.col(f"{f}{s}"))).alias(f"abs{s}__{f}"), F.avg(f"{f}{s}").alias(f"avg{s}__{f}")]
    wide = scored.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(s.strip("_")).alias("model"),
                              F.col(f"abs{s}__{f}").alias("mean_abs"), F.col(f"avg{s}__{f}").alias("mean"))
                     for f in features for s in suffixes])
    return wide.select(F.inline(rows))
