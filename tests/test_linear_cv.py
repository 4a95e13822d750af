"""Cross-validated logistic regression: no leak, held-out scores by hand, and the explanation of the mean model."""

import math

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import linear_cv as L, split as SP
from satlens.operators.contributions import linear_contributions
from satlens.operators.models import logistic, probability


@pytest.fixture(scope="module")
def folds(inputs):
    d = SP.kfold_ids(inputs.model_input, 3, [C.PROMOTER], seed=1)
    return d, L.cross_validate_lr(d, C.FEATURES, C.PROMOTER, k=3)


def test_fold_sees_the_others_only(folds):
    d, kept = folds
    changed = d.withColumn("ticket_price", F.when(F.col("fold") == 0, 1e6).otherwise(F.col("ticket_price")))
    again = L.cross_validate_lr(changed, C.FEATURES, C.PROMOTER, k=3)
    assert again[0].fills == kept[0].fills and again[0].weights == pytest.approx(kept[0].weights, abs=1e-9)
    assert again[1].fills["ticket_price"] != kept[1].fills["ticket_price"]


def test_held_out_scores(folds):
    d, kept = folds
    own = probability(d.where("fold = 1").select(C.ID, *[F.col(f).cast("double").alias(f) for f in C.FEATURES]),
                      logistic(d.where("fold <> 1"), C.FEATURES, C.PROMOTER), "p").select(C.ID, "p")
    ours = L.held_out(d, kept, "q").where("fold = 1").select(C.ID, "q")
    worst = own.join(ours, C.ID).agg(F.max(F.abs(F.col("p") - F.col("q"))), F.count("*")).first()
    assert worst[0] < 1e-6 and worst[1] == d.where("fold = 1").count() > 0
    assert L.held_out(d.withColumn("fold", F.lit(None).cast("int")), kept, "q").where("q IS NOT NULL").count() == 0


def test_mean_model_explained(inputs, folds):
    m = L.mean_model(folds[1])
    t = linear_contributions(inputs.model_input, m.weights, "_prom", intercept=m.intercept, fill=m.fills)
    for r in t.limit(50).collect():
        margin = m.intercept + sum(w * (m.fills[f] if r[f] is None else float(r[f])) for f, w in m.weights.items())
        assert r["base_value_prom"] + sum(r[f"{f}_prom"] for f in C.FEATURES) == pytest.approx(margin, rel=1e-9, abs=1e-9)
        assert r["out_prob_prom"] == pytest.approx(1 / (1 + math.exp(-max(margin, -700))), abs=1e-9)  # exp overflows beyond


def test_registered_queries(inputs):
    from satlens.plans.q_ml import q_train_lr, q_train_lr_shap
    got = q_train_lr(inputs).collect()
    assert {r["fold"] for r in got} == set(range(5)) and len(got) == inputs.model_input.select(*C.SEGMENT).distinct().count() * 5
    assert q_train_lr_shap(inputs).count() == inputs.model_input.count()
