"""Uncertainty of predictions and of sample NPS (§2.5 A26-A27, §2.10 M21-M23).

Random samples are drawn by ranking rows on a seeded hash (portable and
reproducible): ``row_number() over (partition by sample order by hash) <= n``
is planned as a per-task top-n before the shuffle, so every sample costs at
most n rows per map task whatever the table size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators.explain import PERIOD
from satlens.operators.joins import left_join_null_safe
from satlens.operators.stats import exact_quantiles

PRED = "out_prob_nps"
UNC = "uncertainty_nps"


def hash_order(key: str, seed, salt: Column | None = None) -> Column:
    """md5 of 'key-seed[-salt]': a uniform, reproducible random order."""
    parts = [F.col(key).cast("string"), F.lit(str(seed))]
    if salt is not None:
        parts.append(salt.cast("string"))
    return F.md5(F.concat_ws("-", *parts))


def hash_top_n(df: DataFrame, group: Sequence[str], key: str, seed, n: int, salt: Column | None = None,
               hex_digits: int = 3, rank_col: str = "rn") -> DataFrame:
    """The n rows with the smallest seeded hash per group, ranked 1..n (exact).

    Rows are counted per (group, hash-prefix bucket), 16^3 a group, so that a
    task counts few groups whatever its rows; running counts over the
    buckets (a small table) show which buckets can hold ranks <= n, and only
    rows of those buckets reach the final ranking window.  The work therefore
    does not depend on the optimizer's partial top-k threshold, and no group
    is ever sorted whole in one task.
    """
    group = list(group)
    h = hash_order(key, seed, salt)
    t = df.withColumns({"__h": h, "__b": F.conv(F.substring(h, 1, hex_digits), 16, 10).cast("long")})
    counts = t.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    last = (counts.withColumn("__off", F.coalesce(F.sum("__c").over(w), F.lit(0))).filter(F.col("__off") < n)
            .groupBy(*group).agg(F.max("__b").alias("__last")))
    # a row a group: with it in every task, rows of later buckets go before anything is shuffled
    cand = left_join_null_safe(t, F.broadcast(last), group, "inner").filter(F.col("__b") <= F.col("__last")).drop("__last")
    rw = Window.partitionBy(*group).orderBy("__h", key)
    return cand.withColumn(rank_col, F.row_number().over(rw)).filter(F.col(rank_col) <= n).drop("__b")


def confidence_tier(scored: DataFrame, column: str = UNC, quantiles=C.TIER_QUANTILES,
                    labels=C.TIER_LABELS) -> DataFrame:
    """High below the first quantile of uncertainty, Medium below the second,
    else Low; exact quantiles are scalar subqueries (computed once)."""
    q = exact_quantiles(scored, column, list(quantiles))
    both = q.select(F.struct(*q.columns)).scalar()  # one subquery, read twice
    q1, q2 = (both.getField(n) for n in q.columns)
    u = F.col(column)
    return scored.withColumn("confidence_level", F.when(u < q1, F.lit(labels[0]))
                             .when(u < q2, F.lit(labels[1])).otherwise(F.lit(labels[2])))


def error_bars(scored: DataFrame, period: Column, segment: Sequence[str] = C.SEGMENT,
               pred: str = PRED, unc: str = UNC, score: str = C.SCORE) -> DataFrame:
    """Per period and segment (x100 units): mean prediction, systematic error
    (mean model uncertainty), SEM = std(prediction) / sqrt(n), total error =
    sqrt(systematic^2 + SEM^2), and the observed NPS."""
    from satlens.functions.aggregates import nps
    n = F.count(pred)
    sem = F.stddev_samp(pred) / F.sqrt(n)
    t = scored.groupBy(period.alias(PERIOD), *segment).agg(
        n.alias("n"), (F.avg(pred) * 100).alias("prediction_pct"), (F.avg(unc) * 100).alias("systematic_pct"),
        (sem * 100).alias("sem_pct"), nps(score, scale=100.0).alias("actual"))
    return t.withColumn("total_error_pct", F.sqrt(F.col("systematic_pct") ** 2 + F.coalesce(F.col("sem_pct"), F.lit(0.0)) ** 2))


def trust_verdict(bars: DataFrame, adjusted: DataFrame | None = None, segment: Sequence[str] = C.SEGMENT,
                  quantiles=C.TIER_QUANTILES) -> DataFrame:
    """Not trusted when the observed NPS falls outside prediction +- total
    error, or when an indirect adjustment was needed; otherwise graded by
    the length of the error bar against its own quantiles (High / Medium / Low)."""
    b = bars
    if adjusted is not None:
        ind = (adjusted.groupBy(PERIOD, *segment)
               .agg(F.max((F.col("method_used") == "indirect").cast("int")).alias("__ind")))
        b = left_join_null_safe(b, ind, [PERIOD, *segment])
    else:
        b = b.withColumn("__ind", F.lit(0))
    q = exact_quantiles(bars, "total_error_pct", list(quantiles))
    both = q.select(F.struct(*q.columns)).scalar()
    q1, q2 = (both.getField(n) for n in q.columns)
    outside = F.abs(F.col("actual") - F.col("prediction_pct")) > F.col("total_error_pct")
    e = F.col("total_error_pct")
    grade = F.when(e < q1, "High").when(e < q2, "Medium").otherwise("Low")
    verdict = (F.when(F.col("actual").isNull(), F.lit("no data"))
               .when(outside, F.lit("not trusted: outside error"))
               .when(F.coalesce(F.col("__ind"), F.lit(0)) == 1, F.lit("not trusted: indirect adjustment"))
               .otherwise(F.concat(F.lit("trusted: "), grade)))
    return b.withColumn("verdict", verdict).drop("__ind")


def sample_uncertainty(scored: DataFrame, n_samples: int = 10, sample_size: int = 100, seed: int = 42,
                       key: str = C.ID, pred: str = PRED, unc: str = UNC, quadratic: bool = False) -> DataFrame:
    """k random samples of n rows: mean prediction, mean model uncertainty,
    SEM = std(prediction, ddof 1) / sqrt(rows drawn) and total (sum, or quadratic).
    A sample of a table with fewer rows than asked holds them all (column n)."""
    s = F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1)))
    t = scored.select(key, pred, unc, s.alias("sample"))
    t = hash_top_n(t, ["sample"], key, seed, sample_size, salt=F.col("sample"))
    sem = F.stddev_samp(pred) / F.sqrt(F.count(pred))
    out = t.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.avg(pred).alias("mean_prediction"),
                                  F.avg(unc).alias("model_uncertainty"), sem.alias("sem"))
    total = (F.sqrt(F.col("model_uncertainty") ** 2 + F.col("sem") ** 2) if quadratic
             else F.col("model_uncertainty") + F.col("sem"))
    return out.withColumn("total_uncertainty", total)


def uncertainty_curve(scored: DataFrame, sizes: Sequence[int] = tuple(range(100, 3001, 50)),
                      n_iterations: int = 1, seed: int = 42, key: str = C.ID, pred: str = PRED,
                      unc: str = UNC, score: str = C.SCORE) -> DataFrame:
    """Uncertainty against sample size.  One random order per iteration; the
    sample of size s is its first s rows (nested samples), so only the first
    max(sizes) rows of each order are kept (per-task top-n) and running sums
    over them give every size at once.  Averaged over iterations per size:
    mean prediction, model uncertainty, SEM, total = sqrt(model^2 + SEM^2),
    NPS (fraction) and relative uncertainty.  Every size has a row; a size above
    the table's row count has NULL statistics and ``n_rows``, the rows there are."""
    m = max(sizes)
    it = F.explode(F.sequence(F.lit(0), F.lit(n_iterations - 1)))
    t = scored.select(key, pred, unc, score, it.alias("iteration"))
    t = hash_top_n(t, ["iteration"], key, seed, m, salt=F.col("iteration"))
    run = Window.partitionBy("iteration").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, 0)
    sc = F.col(score)
    t = t.withColumns({
        "__s1": F.sum(pred).over(run), "__s2": F.sum(F.col(pred) * F.col(pred)).over(run),
        "__u": F.sum(unc).over(run), "__na": F.count(sc).over(run),
        "__pd": F.sum(F.when(sc > C.PROMOTER_ABOVE, 1).when(sc <= C.DETRACTOR_AT_MOST, -1).otherwise(0)).over(run)})
    t = t.filter(F.col("rn").isin([int(s) for s in sizes]))
    n = F.col("rn").cast("double")
    mean = F.col("__s1") / n
    var = (F.col("__s2") - F.col("__s1") * F.col("__s1") / n) / (n - 1)
    sem = F.sqrt(F.greatest(var, F.lit(0.0))) / F.sqrt(n)
    model = F.col("__u") / n
    per = t.select(F.col("rn").alias("sample_size"), "iteration", mean.alias("mean_prediction"),
                   model.alias("model_uncertainty"), sem.alias("sem"),
                   F.sqrt(model * model + sem * sem).alias("total_uncertainty"),
                   F.try_divide(F.col("__pd").cast("double"), F.col("__na").cast("double")).alias("nps"))
    out = per.groupBy("sample_size").agg(
        F.avg("mean_prediction").alias("mean_prediction"), F.avg("model_uncertainty").alias("model_uncertainty"),
        F.avg("sem").alias("sem"), F.avg("total_uncertainty").alias("total_uncertainty"), F.avg("nps").alias("nps"))
    out = out.withColumn("rel_uncertainty", F.col("total_uncertainty") / F.col("mean_prediction"))
    rows = scored.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    asked = (scored.sparkSession.range(1).select(F.explode(F.lit([int(s) for s in sizes])).alias("sample_size"))
             .withColumn("n_rows", F.least(F.col("sample_size"), rows).cast("bigint")))
    return asked.join(out, "sample_size", "left")
