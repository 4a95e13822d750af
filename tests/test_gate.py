"""The champion gate: its branches, and each rule failing once."""

import pytest

from satlens.operators.metrics import champion_gate, rejected_metrics

GOOD = {"auc": 0.95, "recall": 0.9, "precision": 0.5, "f1": 0.6, "accuracy": 0.9}


def table(spark, test, train=None, model="m"):
    rows = [(model, "test", k, v) for k, v in test.items()] + [(model, "train", k, v) for k, v in (train or test).items()]
    return spark.createDataFrame(rows, "model string, dataset string, metric string, value double")


def decide(spark, new, old, **kw):
    return champion_gate(new, old, **kw).first()


def test_first_run_and_other_features_deploy(spark):
    bad = table(spark, {k: 0.01 for k in GOOD})
    assert decide(spark, bad, None)["deploy"] and decide(spark, bad, None)["reason"] == "first run"
    r = decide(spark, bad, table(spark, GOOD), n_features=18, champion_features=17)
    assert r["deploy"] and r["reason"] == "features: 17 -> 18" and r["failed_rules"] == []
    assert not decide(spark, bad, table(spark, GOOD), n_features=18, champion_features=18)["deploy"]


@pytest.mark.parametrize("test, train, failed", [
    ({}, {}, []),
    ({"recall": 0.84}, {"recall": 0.84}, ["recall: gain below minimum"]),
    ({"auc": 0.89}, {"auc": 0.89}, ["auc: below floor"]),
    ({"precision": 0.5}, {"precision": 0.56}, ["precision: train/test gap"]),
    ({"accuracy": 0.975}, {"accuracy": 0.975}, ["accuracy: train too high"]),
])
def test_rules(spark, test, train, failed):
    new = table(spark, GOOD | test, GOOD | train)
    r = champion_gate(new, table(spark, GOOD | {"recall": 0.8}))
    assert r.first()["failed_rules"] == failed and r.first()["deploy"] == (not failed) and r.first()["reason"] == "rules"
    assert rejected_metrics(new, r).count() == (10 if failed else 0)
