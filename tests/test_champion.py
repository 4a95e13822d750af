"""The champion cycle through the store: first run, gain, rejection, other features, a killed publish."""

import os

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import models
from satlens.sources import models_store as S


def metrics(spark, train, test):
    return spark.createDataFrame([(lab, d, m, v) for lab in C.LABELS for d, v in (("train", train), ("test", test))
                                  for m in ("auc", "recall", "precision", "f1", "accuracy")], "model string, dataset string, metric string, value double")


@pytest.fixture(scope="module")
def pair(spark, inputs):
    return models.train_pair(inputs.model_input.limit(400), params={"maxIter": 2, "maxDepth": 2, "seed": 0})


def test_cycle(spark, pair, inputs, tmp_path):
    root = f"{tmp_path}/store"
    assert S.champion(spark, root) is None
    run = lambda day, test, features=C.FEATURES: S.deploy_or_reject(spark, root, day, pair, metrics(spark, test, test), features)
    first = run("2000-01-01", 0.85).collect()
    assert all(r["published"] and r["reason"] == "first run" for r in first) and S.champion(spark, root).version == "2000-01-01"
    gain = run("2000-02-01", 0.92).collect()
    assert all(r["published"] and r["failed_rules"] == [] for r in gain)
    worse = run("2000-03-01", 0.91).collect()
    assert not any(r["published"] for r in worse) and all(r["failed_rules"] for r in worse)
    assert spark.read.parquet(f"{root}/rejected/2000-03-01").count() == 2 * 2 * 5
    now = S.champion(spark, root)
    assert now.version == "2000-02-01" and now.features == C.FEATURES and now.metrics.where("value <> 0.92").count() == 0
    rows = models.assemble(inputs.model_input.select(C.ID, *C.FEATURES).limit(50), C.FEATURES)
    for lab, model in now.models.items():
        both = models.probability(models.probability(rows, model, "a"), pair[lab], "b")
        assert both.where(F.col("a") != F.col("b")).count() == 0
    other = run("2000-04-01", 0.50, [*C.FEATURES[:-1], "another"]).collect()
    assert all(r["published"] and r["reason"].startswith("other features") for r in other)
    assert S.champion(spark, root).version == "2000-04-01"


def test_killed_publish_leaves_the_old_version(spark, pair, tmp_path, monkeypatch):
    root = f"{tmp_path}/store"
    S.publish(spark, root, "2000-01-01", pair, metrics(spark, 0.8, 0.8), C.FEATURES)

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(S, "point_to", killed)
    with pytest.raises(KeyboardInterrupt):
        S.publish(spark, root, "2000-02-01", pair, metrics(spark, 0.9, 0.9), C.FEATURES)
    assert S.champion(spark, root).version == "2000-01-01" and len(os.listdir(f"{root}/versions")) == 2
    monkeypatch.undo()
    S.publish(spark, root, "2000-02-01", pair, metrics(spark, 0.9, 0.9), C.FEATURES)
    assert S.champion(spark, root).version == "2000-02-01"
