"""Registered queries: MLlib models, scoring, Tree SHAP, virtual ensemble,
imputation and encoders (inventory §2.10 M4-M8, M12-M13, M16-M19; §2.1 S10-S11).

Models are fitted on the driver's tables at the requested scale factor; the
queries without an oracle return one row per scored respondent (or per fold /
grid point / label), which the driver checks by rows.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from functools import reduce

from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import boosting, daily, imputers, linear_cv, metrics as M, models, search, split as SP, stats
from satlens.operators import trees as TR
from satlens.operators.contributions import linear_contributions
from satlens.operators.treeshap import explain_many
from satlens.plans.oracle_base import MODEL
from satlens.plans.registry import Inputs, input_state, register, rounded
from satlens.plans.scoring import predict_and_explain
from satlens.session import scratch_path

# As many trees as SURVEY 7.5 allows a query: the ensembles of C.ENSEMBLE_STEP hold three truncated models.
QUERY_GBT = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.2, "seed": 0}

# Fewer rounds than search.RUNGS; the points, samples, folds and labels are the production ones.
QUERY_RUNGS = ((1 / 27, 2), (1 / 9, 4), (1 / 3, 8), (1.0, 12))


# Fewer rounds than imputers.PARAMS.
QUERY_IMPUTER = {"maxIter": 20}

#: (application, state of the input) -> the fitted pair and its trees: model metadata, fitted once an application.
_FITTED: dict[tuple, tuple[dict, dict]] = {}


def _pair(x: Inputs):
    key = (x.spark.sparkContext.applicationId, input_state(x.spark, x.sf_dir))
    if key not in _FITTED:
        fitted = models.train_pair(x.model_input, params=QUERY_GBT)
        _FITTED[key] = fitted, {lab: TR.read_trees(x.spark, m) for lab, m in fitted.items()}
    x._models, pair = _FITTED[key]
    return pair


@register("train_pair")
def q_train_pair(x: Inputs):
    pair = _pair(x)
    mi = x.model_input
    rows = []
    for lab, trees in pair.items():
        s = x.persist(TR.score(mi.select(*C.FEATURES, *C.LABELS), trees, C.FEATURES, "__p"), f"train-scores-{lab}")
        b = M.binary_metrics(s, lab, "__p")
        rows.append(b.select(F.lit(lab).alias("label"), F.lit(len(trees)).alias("n_trees"),
                             F.lit(sum(len(t.nodes) for t in trees)).alias("n_nodes"), "auc", "accuracy"))
    return rounded(rows[0].unionByName(rows[1]))


@register("score_pair")
def q_score_pair(x: Inputs):
    pair = _pair(x)
    s = TR.score_many(x.model_input.select(C.ID, *C.FEATURES),
                      {"out_prob_prom": pair[C.PROMOTER], "out_prob_det": pair[C.DETRACTOR]}, C.FEATURES)
    return rounded(s.select(C.ID, "out_prob_prom", "out_prob_det",
                            (F.col("out_prob_prom") > 0.5).cast("int").alias("prediction_prom"),
                            (F.col("out_prob_det") > 0.5).cast("int").alias("prediction_det")))


@register("tree_shap")
def q_tree_shap(x: Inputs):
    """Both models' contributions; efficiency_error: how far the worse one's sum is from the log-odds."""
    pair = _pair(x)
    models_of = {"_prom": pair[C.PROMOTER], "_det": pair[C.DETRACTOR]}
    t = explain_many(x.model_input, models_of, C.FEATURES)
    t = TR.margins(t, {f"__m{s}": trees for s, trees in models_of.items()}, C.FEATURES)
    error = F.greatest(*[F.abs(F.col(f"out_value{s}") - F.col(f"__m{s}")) for s in models_of])
    return rounded(t.select(C.ID, *[f"{c}{s}" for s in models_of for c in [*C.FEATURES, "base_value", "out_value"]],
                            error.alias("efficiency_error")))


@register("virtual_ensemble")
def q_virtual_ensemble(x: Inputs):
    pair = _pair(x)
    t = TR.virtual_ensemble_many(x.model_input, {"_prom": pair[C.PROMOTER], "_det": pair[C.DETRACTOR]}, C.FEATURES,
                                 C.ENSEMBLE_STEP)
    return rounded(t.select(C.ID, "mean_proba_prom", "uncertainty_prom", "mean_proba_det", "uncertainty_det"))


SCORED_COLUMNS = (["model_version", C.ID, C.DATE, *C.FEATURES] + [f"{f}_nps" for f in C.FEATURES]
                  + ["base_prob_nps", "out_prob_nps", "uncertainty_nps", C.SNAPSHOT])


@register("predict_explain")
def q_predict_explain(x: Inputs):
    pair = _pair(x)
    t = predict_and_explain(x.model_input, pair[C.PROMOTER], pair[C.DETRACTOR],
                            lineage={"model_version": "gbt-query"})
    t = t.withColumn(C.SNAPSHOT, F.col(C.DATE))
    return rounded(t.select(*SCORED_COLUMNS))


@register("score_quarters")
def q_score_quarters(x: Inputs):
    """Historic scoring of the four quarters as one job (quarter is a column)."""
    pair = _pair(x)
    t = predict_and_explain(x.model_input.withColumn("quarter", F.quarter(C.DATE)),
                            pair[C.PROMOTER], pair[C.DETRACTOR])
    return rounded(t.groupBy("quarter").agg(F.count(F.lit(1)).alias("n"),
                                            F.avg("out_prob_nps").alias("mean_out_prob_nps"),
                                            F.avg("uncertainty_nps").alias("mean_uncertainty_nps")))


@register("score_daily")
def q_score_daily(x: Inputs):
    """A backfill of all days: in 1997 by a pair fitted to the end of 1996, from 2000 on by the pair of all rows; none before."""
    _pair(x)
    root, store = (scratch_path(x.spark, f"{n}/{uuid.uuid4().hex}") for n in ("daily-models", "daily-scored"))
    early = models.train_pair(x.model_input.where(F.col(C.DATE) < dt.date(1997, 1, 1)), params={**QUERY_GBT, "maxIter": 15})
    daily.save_pair(x.spark, root, "1997-01-01", early)
    daily.save_pair(x.spark, root, "2000-01-01", x._models)
    daily.score_days(x.model_input, root, store, "1900-01-01", "2100-01-01", SCORED_COLUMNS)
    return rounded(x.spark.read.parquet(store).select(*SCORED_COLUMNS))


def _five_folds(x: Inputs):
    """Written once, as fits, losses and scores all read it."""
    rows = x.model_input.select(C.ID, *C.SEGMENT, *C.FEATURES, *C.LABELS)
    return x.persist(SP.kfold_ids(rows, 5, [C.PROMOTER], seed=1), "five-folds")


@register("cv_scores")
def q_cv_scores(x: Inputs):
    """Both labels, five folds: each fold's model is cut at its best round; all metrics come from rows it did not see."""
    d = _five_folds(x)
    kept = boosting.cross_validate(d, k=5, params=QUERY_GBT, patience=10)
    s = x.persist(boosting.held_out_scores(d.select("fold", *C.FEATURES, *C.LABELS), kept), "cv-scores")
    long = reduce(lambda a, b: a.unionByName(b), [s.select(F.lit(lab).alias("label"), "fold", F.col(lab).alias("y"), F.col(f"p_{lab}").alias("p"))
                                                 for lab in C.LABELS])
    rounds = x.spark.createDataFrame([(m.label, m.fold, m.best_round, len(m.losses), float(m.losses[m.best_round - 1])) for m in kept],
                                     "label string, fold int, best_round int, rounds int, best_log_loss double")
    report = M.class_report(long, "y", "p", ["label", "fold"]).drop("tp", "fp", "fn", "tn")
    metrics = M.binary_metrics(long, "y", "p", ["label", "fold"])
    return rounded(rounds.join(report, ["label", "fold"]).join(metrics, ["label", "fold"]))


@register("param_search")
def q_param_search(x: Inputs):
    """50 points a label in four rungs; one row a trial and rung, the last rung's winner is marked."""
    d = _five_folds(x)
    trials, best = search.search(d, k=5, trials=50, seed=7, rungs=QUERY_RUNGS, table=scratch_path(x.spark, f"trials-{uuid.uuid4().hex}"))
    last = len(QUERY_RUNGS) - 1
    wins = F.lit(False)
    for lab, point in best.items():
        wins = wins | ((F.col("label") == lab) & (F.col("rung") == last) & (F.col("best_round") == point["maxIter"])
                       & (F.col("stepSize") == point["stepSize"]))
    return rounded(trials.withColumn("best", wins))


def _cross_validated_lr(x: Inputs, label: str):
    d = _five_folds(x)
    return d, linear_cv.cross_validate_lr(d, C.FEATURES, label)


@register("train_lr")
def q_train_lr(x: Inputs):
    """Five folds of the promoter's logistic regression: metrics of the rows held out, by fold and segment."""
    d, folds = _cross_validated_lr(x, C.PROMOTER)
    scored = x.persist(linear_cv.held_out(d.select("fold", *C.SEGMENT, *C.FEATURES, C.PROMOTER), folds, "__p"), "lr-scores")
    by = ["fold", *C.SEGMENT]
    report = M.class_report(scored, C.PROMOTER, "__p", by).drop("tp", "fp", "fn", "tn")
    return rounded(M.binary_metrics(scored, C.PROMOTER, "__p", by).join(report, by))


@register("train_lr_shap")
def q_train_lr_shap(x: Inputs):
    """The folds' mean model, explained: contributions of every respondent's features to the log-odds."""
    _, folds = _cross_validated_lr(x, C.PROMOTER)
    m = linear_cv.mean_model(folds)
    t = linear_contributions(x.model_input, m.weights, "_prom", intercept=m.intercept, fill=m.fills)
    return rounded(t.select(C.ID, *[f"{f}_prom" for f in C.FEATURES], "base_value_prom", "out_value_prom", "out_prob_prom"))


@register("model_roundtrip")
def q_model_roundtrip(x: Inputs):
    from pyspark.ml.classification import GBTClassificationModel
    _pair(x)
    m = x._models[C.PROMOTER]
    path = scratch_path(x.spark, f"models/{uuid.uuid4().hex}/promoter")
    m.write().overwrite().save(path)
    back = GBTClassificationModel.load(path)
    a = models.assemble(x.model_input.select(C.ID, *C.FEATURES), C.FEATURES)
    p1 = models.probability(a, m, "p_saved")
    p2 = models.probability(p1, back, "p_loaded")
    return rounded(p2.select(C.ID, "p_saved", "p_loaded"))


@register("model_asof")
def q_model_asof(x: Inputs):
    """Versioned model folders by date, neighbours with different models; pick the
    latest version <= as-of and score it beside the model that was stored then."""
    from pyspark.ml.classification import GBTClassificationModel
    from satlens.sources.models_store import latest_version, save_version
    _pair(x)
    root = scratch_path(x.spark, f"models/{uuid.uuid4().hex}")
    for d, label in (("2000-01-01", C.DETRACTOR), ("2000-06-01", C.PROMOTER), ("2001-01-01", C.DETRACTOR)):
        save_version(x._models[label], root, "promoter", d)
    v = latest_version(x.spark, root, "promoter", "2000-12-31")
    m = GBTClassificationModel.load(os.path.join(root, "promoter", v))
    a = models.assemble(x.model_input.select(C.ID, *C.FEATURES), C.FEATURES)
    scored = models.probability(models.probability(a, m, "p"), x._models[C.PROMOTER], "p_stored")
    return rounded(scored.select(C.ID, F.lit(v).alias("model_version"), "p", "p_stored"))


@register("impute_gbt")
def q_impute_gbt(x: Inputs):
    """Monthly imputers through their store: all months fitted to the end of 1997, the first half-year's again to June 2000;
    the whole table filled as of two days.  One row a day, month and version used."""
    mi = x.model_input.withColumn("month", F.month(C.DATE))
    numeric, root = ["load_factor", *C.TOUCHPOINTS, C.OTP], scratch_path(x.spark, f"imputers/{uuid.uuid4().hex}")
    early = mi.where(F.col(C.DATE) <= dt.date(1997, 12, 31))
    late = mi.where((F.col(C.DATE) <= dt.date(2000, 6, 30)) & (F.col("month") <= 6))
    for version, rows in (("1997-12-31", early), ("2000-06-30", late)):
        imputers.save_months(x.spark, root, version, imputers.fit_months(rows, "ticket_price", numeric, C.SEGMENT, params=QUERY_IMPUTER))
    days = [imputers.predict_and_fill(mi, root, day, "ticket_price").withColumn("as_of", F.lit(day)) for day in ("1999-12-31", "2000-12-31")]
    return rounded(days[0].unionByName(days[1]).groupBy("as_of", "month").agg(
        F.max("imputer_version").alias("imputer_version"), F.count(F.lit(1)).alias("n"), F.count("ticket_price").alias("n_known"),
        F.count("ticket_price_imputed").alias("n_filled"), F.avg("ticket_price_imputed").alias("mean_price")))


@register("impute_month_median", MODEL + """
, med AS (SELECT CAST(month(date_flight_local) AS INTEGER) AS month, quantile_cont(ticket_price, 0.5) AS q_50
          FROM model_input WHERE ticket_price IS NOT NULL GROUP BY ALL)
SELECT m.respondent_id, round(coalesce(m.ticket_price, med.q_50), 6) AS ticket_price_imputed
FROM model_input m LEFT JOIN med ON CAST(month(m.date_flight_local) AS INTEGER) = med.month""")
def q_impute_month_median(x: Inputs):
    mi = x.model_input.withColumn("month", F.month(C.DATE))
    med = stats.exact_quantiles(mi, "ticket_price", [0.5], ["month"])
    j = mi.join(med, "month", "left")
    return rounded(j.select(C.ID, F.coalesce("ticket_price", "q_50").alias("ticket_price_imputed")))


@register("impute_median", MODEL + """
, med AS (SELECT quantile_cont(ticket_price, 0.5) AS tp, quantile_cont(load_factor, 0.5) AS lf FROM model_input)
SELECT respondent_id, round(coalesce(ticket_price, tp), 6) AS ticket_price, round(coalesce(load_factor, lf), 6) AS load_factor
FROM model_input, med""")
def q_impute_median(x: Inputs):
    mi = x.model_input
    fills = {}
    for c in ("ticket_price", "load_factor"):
        q = stats.exact_quantiles(mi, c, [0.5])
        fills[c] = F.coalesce(F.col(c), q.select("q_50").scalar())
    return rounded(mi.select(C.ID, *[v.alias(k) for k, v in fills.items()]))


@register("one_hot", MODEL + """
, ci AS (SELECT cabin_in_surveyed_flight, row_number() OVER (ORDER BY n DESC, cabin_in_surveyed_flight) - 1 AS idx
         FROM (SELECT cabin_in_surveyed_flight, count(*) AS n FROM model_input GROUP BY ALL)),
hi AS (SELECT haul, row_number() OVER (ORDER BY n DESC, haul) - 1 AS idx
         FROM (SELECT haul, count(*) AS n FROM model_input GROUP BY ALL))
SELECT m.respondent_id, CAST(ci.idx AS DOUBLE) AS cabin_in_surveyed_flight_idx, CAST(hi.idx AS DOUBLE) AS haul_idx,
  CAST(ci.idx = 0 AS INTEGER) AS cabin_slot0, CAST(hi.idx = 0 AS INTEGER) AS haul_slot0
FROM model_input m JOIN ci USING (cabin_in_surveyed_flight) JOIN hi USING (haul)""")
def q_one_hot(x: Inputs):
    from pyspark.ml.functions import vector_to_array
    t = models.one_hot(x.model_input.select(C.ID, C.CABIN, C.HAUL), [C.CABIN, C.HAUL])
    return t.select(C.ID, f"{C.CABIN}_idx", f"{C.HAUL}_idx",
                    vector_to_array(F.col(f"{C.CABIN}_vec"))[0].cast("int").alias("cabin_slot0"),
                    vector_to_array(F.col(f"{C.HAUL}_vec"))[0].cast("int").alias("haul_slot0"))


@register("champion_gate")
def q_champion_gate(x: Inputs):
    """Three cycles through the store: a first run, a stronger pair against it, the first pair again."""
    from satlens.sources import models_store
    mi = x.model_input.withColumn("year", F.year(C.DATE))
    sp = SP.split_stratified(mi.select(C.ID, "year", *C.FEATURES, *C.LABELS), ["year"], 0.2, 0.0, seed=0)
    sp = x.persist(sp.select(*C.FEATURES, *C.LABELS, "split"), "gate-split")  # fits and scores read it
    train = sp.filter(F.col("split") == "train")
    new = models.train_pair(train, params=QUERY_GBT)
    old = models.train_pair(train, params={**QUERY_GBT, "maxDepth": 2, "maxIter": 5})

    def long(fitted, tag):
        p = {lab: f"__p_{lab}" for lab in fitted}
        s = TR.score_many(sp, {p[lab]: boosting.node_trees(m) for lab, m in fitted.items()}, C.FEATURES)
        s = x.persist(s.select("split", *C.LABELS, *p.values()), f"gate-scores-{tag}")
        parts = []
        for lab in fitted:
            b = M.binary_metrics(s, lab, p[lab], ["split"]).withColumnRenamed("split", "dataset")
            parts.append(M.metrics_long(b.withColumn("model", F.lit(lab)), ["model", "dataset"]))
        return x.persist(parts[0].unionByName(parts[1]), f"gate-metrics-{tag}")

    root, judged = scratch_path(x.spark, f"champions/{uuid.uuid4().hex}"), {"old": (old, long(old, "old")), "new": (new, long(new, "new"))}
    cycles = [models_store.deploy_or_reject(x.spark, root, day, *judged[tag], C.FEATURES)
              for day, tag in (("2000-01-01", "old"), ("2000-06-01", "new"), ("2000-12-01", "old"))]
    in_use = models_store.champion(x.spark, root).version
    return reduce(lambda a, b: a.unionByName(b), cycles).withColumn("version_in_use", F.lit(in_use))


@register("train_window")
def q_train_window(x: Inputs):
    """Date-windowed training run on [1996-01-01, 2000-01-01) with three folds: metrics per label and cabin x haul segment,
    of held-out rows by the folds' kept models, of train and test rows by the final ones."""
    run = boosting.train_window(x.model_input, dt.date(1996, 1, 1), dt.date(2000, 1, 1), k=3, params=QUERY_GBT, patience=10)
    rows = x.persist(run.rows.select("split", "fold", *C.FEATURES, *C.LABELS, C.CABIN, C.HAUL), "window-rows")
    held = x.persist(boosting.held_out_scores(rows.where("fold is not null"), run.kept), "window-held-out")
    parts = []
    for lab, m in run.models.items():
        s = x.persist(TR.score(rows, boosting.node_trees(m), C.FEATURES, "__p"), f"window-scores-{lab}")
        both = (s.select("split", lab, "__p", C.CABIN, C.HAUL)
                .unionByName(held.select(F.lit("held out").alias("split"), lab, F.col(f"p_{lab}").alias("__p"), C.CABIN, C.HAUL)))
        parts.append(M.binary_metrics(both, lab, "__p", ["split", C.CABIN, C.HAUL]).withColumns(
            {"label": F.lit(lab), "rounds": F.lit(m.getNumTrees)}))
    return rounded(parts[0].unionByName(parts[1]))
