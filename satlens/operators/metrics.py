"""Classification metrics and the champion gate (§2.5 A22-A24, §2.10 M11).

Confusion counts, log-loss and class shares are one aggregate.  AUC is the
Mann-Whitney statistic with average ranks for ties: scores are reduced to
(group, score) -> (positives, negatives) with a partial aggregate, and the
negatives below each score come from ``stats.value_prefix_sums`` (bucketed
prefix sums with bounded windows), so no group is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators.joins import left_join_null_safe

METRICS = ["auc", "recall", "precision", "f1", "accuracy"]


def score_counts(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives of every (group, score): AUC and confusion counts both come from it, in one shuffle."""
    y = F.col(label)
    return df.groupBy(*group, score).agg(F.count_if(y == 1).alias("__pos"), F.count_if(y != 1).alias("__neg"))


def auc(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """ROC AUC per group (NULL when a group has only one class)."""
    from satlens.operators.stats import value_prefix_sums
    group = list(group)
    per = value_prefix_sums(score_counts(df, label, score, group), F.col(score),
                            {"__p": F.sum("__pos"), "__q": F.sum("__neg")}, group)
    per = per.withColumn("__u", F.col("__p") * (F.col("__q_below") + F.col("__q") * F.lit(0.5)))
    out = per.groupBy(*group).agg(F.sum("__u").alias("__u"), F.sum("__p").alias("__P"), F.sum("__q").alias("__N"))
    return out.select(*group, F.try_divide(F.col("__u"), (F.col("__P") * F.col("__N")).cast("double")).alias("auc"))


def _div0(a, b):
    """a / b with 0 for a zero denominator (the convention of the reference)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, score: str, group: Sequence[str] = (),
                   threshold: float = 0.5, pred: str | None = None) -> DataFrame:
    """AUC, recall, precision, F1 and accuracy per group; predicted class is
    score > threshold unless a prediction column is given."""
    group = list(group)
    counts = score_counts(df, label, pred or score, group)
    p = F.col(pred) if pred else (F.col(score) > F.lit(threshold)).cast("int")
    tp, fp, fn, tn = (F.coalesce(F.sum(F.when(at, F.col(n))), F.lit(0)) for at in (p == 1, p != 1) for n in ("__pos", "__neg"))
    conf = counts.groupBy(*group).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    rec = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    f1 = _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    acc = _div0(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    conf = conf.select(*group, "tp", "fp", "fn", "tn", rec.alias("recall"), prec.alias("precision"),
                       f1.alias("f1"), acc.alias("accuracy"))
    a = auc(df, label, score, group)
    if group:
        return left_join_null_safe(conf, a, group)
    return conf.withColumn("auc", a.select("auc").scalar())


def class_report(df: DataFrame, label: str, score: str, group: Sequence[str] = (),
                 threshold: float = 0.5, eps: float = 1e-15) -> DataFrame:
    """Class shares, confusion matrix, support-weighted precision / recall / F1
    and log-loss (NULL when only one class is present)."""
    group = list(group)
    y = F.col(label)
    pr = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    p = (F.col(score) > F.lit(threshold)).cast("int")
    agg = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_pos"),
        F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y != 1)).alias("fp"),
        F.count_if((p != 1) & (y == 1)).alias("fn"), F.count_if((p != 1) & (y != 1)).alias("tn"),
        F.avg(F.when(y == 1, -F.log(pr)).otherwise(-F.log(1 - pr))).alias("__ll"))
    n, npos = F.col("n"), F.col("n_pos")
    nneg = n - npos
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1_1, f1_0 = _div0(2 * tp, 2 * tp + fp + fn), _div0(2 * tn, 2 * tn + fn + fp)
    wavg = lambda a0, a1: _div0(a0 * nneg + a1 * npos, n)
    return agg.select(
        *group, "n", (npos / n * 100).alias("share_pos_pct"), (nneg / n * 100).alias("share_neg_pct"),
        "tp", "fp", "fn", "tn",
        wavg(p0, p1).alias("precision_weighted"), wavg(r0, r1).alias("recall_weighted"),
        wavg(f1_0, f1_1).alias("f1_weighted"),
        F.when((npos > 0) & (nneg > 0), F.col("__ll")).alias("log_loss"))


def metrics_long(wide: DataFrame, keys: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """(keys..., metric, value) form used by the gate and the metrics sink."""
    return wide.unpivot(list(keys), list(metrics), "metric", "value")


def champion_gate(new: DataFrame, old: DataFrame | None,
                  compare: Mapping[str, float] = C.GATE_COMPARE,
                  floors: Mapping[str, float] = C.GATE_FLOORS, max_gap: float = C.GATE_MAX_GAP,
                  max_train: float = C.GATE_MAX_TRAIN, model_col: str = "model",
                  n_features: int | None = None, champion_features: int | None = None) -> DataFrame:
    """Deploy decision per model from long metrics (model, dataset, metric, value).

    Without a champion (a first run), or when the champion was fitted on another
    number of features, the new model is deployed unchecked; ``reason`` says so.

    Rules: on test, each compared metric improves on the champion's test value
    by at least its minimum gain; every other floored metric reaches its floor;
    |train - test| <= max_gap for every metric; train <= max_train.  Returns one
    row per model with ``deploy`` and the list of failed rules."""
    other_features = None not in (n_features, champion_features) and n_features != champion_features
    if old is None or other_features:
        why = "first run" if old is None else f"features: {champion_features} -> {n_features}"
        return new.select(model_col).distinct().select(model_col, F.array().cast("array<string>").alias("failed_rules"),
                                                       F.lit(True).alias("deploy"), F.lit(why).alias("reason"))
    n = new.groupBy(model_col, "metric").pivot("dataset", ["train", "test"]).agg(F.first("value"))
    o = old.filter(F.col("dataset") == "test").select(model_col, "metric", F.col("value").alias("champion"))
    n = n.join(o, [model_col, "metric"], "left")
    gain = F.create_map(*[x for k, v in compare.items() for x in (F.lit(k), F.lit(float(v)))]) if compare else None
    floor = F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(float(v)))])
    m = F.col("metric")
    need_gain = F.element_at(gain, m) if gain is not None else F.lit(None).cast("double")
    rules = F.array_compact(F.array(
        F.when(need_gain.isNotNull() & F.col("champion").isNotNull() & (F.col("test") - F.col("champion") < need_gain),
               F.concat(m, F.lit(": gain below minimum"))),
        F.when(need_gain.isNull() & F.element_at(floor, m).isNotNull() & (F.col("test") < F.element_at(floor, m)),
               F.concat(m, F.lit(": below floor"))),
        F.when(F.abs(F.col("train") - F.col("test")) > max_gap, F.concat(m, F.lit(": train/test gap"))),
        F.when(F.col("train") > max_train, F.concat(m, F.lit(": train too high")))))
    per = n.withColumn("failed", rules)
    out = per.groupBy(model_col).agg(F.flatten(F.collect_list("failed")).alias("failed_rules"))
    return out.select(model_col, F.array_sort("failed_rules").alias("failed_rules"),
                      (F.size("failed_rules") == 0).alias("deploy"), F.lit("rules").alias("reason"))


def rejected_metrics(new: DataFrame, decision: DataFrame, model_col: str = "model") -> DataFrame:
    """The metrics of models that the gate turned down, for the not-deployed sink."""
    return new.join(decision.where("not deploy").select(model_col), model_col, "left_semi")
