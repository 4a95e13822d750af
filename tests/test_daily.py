"""Daily scoring: versions by day, a backfill against runs a day, and reruns of one day."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import boosting, daily as D, models
from satlens.plans.scoring import predict_and_explain
from satlens.sources import models_store as S

COLUMNS = [C.ID, C.DATE, "out_prob_nps", "uncertainty_nps", "base_prob_nps", *[f"{f}_nps" for f in C.FEATURES]]


@pytest.fixture(scope="module")
def stored(spark, inputs, tmp_path_factory):
    """Two versions and 40 days of rows, some before the first version."""
    root = str(tmp_path_factory.mktemp("versions"))
    rows = inputs.model_input
    days = sorted(r[0] for r in rows.select(C.DATE).distinct().collect())[:40]
    rows = inputs.persist(rows.where(F.col(C.DATE) <= days[-1]), "daily-test")
    pairs = {}
    for day, trees in ((days[10], 4), (days[25], 6)):
        pairs[str(day)] = models.train_pair(inputs.model_input, params={"maxIter": trees, "maxDepth": 2, "seed": 0})
        D.save_pair(spark, root, str(day), pairs[str(day)])
    return root, rows, [str(d) for d in days], pairs


def table(df):
    return sorted((r.asDict() for r in df.select("model_version", C.SNAPSHOT, *COLUMNS).collect()), key=lambda r: r[C.ID])


def test_backfill_equals_runs_a_day(spark, stored, tmp_path):
    root, rows, days, pairs = stored
    D.score_days(rows, root, f"{tmp_path}/all", days[0], days[-1], COLUMNS, step=1)
    for day in days:
        D.score_days(rows, root, f"{tmp_path}/single", day, day, COLUMNS, step=1)
    back = spark.read.parquet(f"{tmp_path}/all")
    got = table(back)
    assert got == table(spark.read.parquet(f"{tmp_path}/single")) and len(got) == rows.count()
    for r in got:
        day = str(r[C.DATE])
        assert r["model_version"] == (None if day < days[10] else days[10] if day < days[25] else days[25])
        assert (r["out_prob_nps"] is None) == (r["model_version"] is None)
    for version, fitted in pairs.items():  # each version's rows are those of the version alone
        trees = {lab: boosting.node_trees(m) for lab, m in fitted.items()}
        alone = predict_and_explain(rows, trees[C.PROMOTER], trees[C.DETRACTOR], step=1).select(C.ID, F.col("out_prob_nps").alias("p"))
        own = back.where(F.col("model_version") == version).join(alone, C.ID)
        n, worst = own.agg(F.count("*"), F.max(F.abs(F.col("p") - F.col("out_prob_nps")))).first()
        assert n == back.where(F.col("model_version") == version).count() > 0 and worst < 1e-12


def test_rerun_replaces_its_day_only(spark, stored, tmp_path):
    root, rows, days, _ = stored
    store = f"{tmp_path}/store"
    D.score_days(rows, root, store, days[20], days[30], COLUMNS)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store}/*/*.parquet")}
    before, old = files(), table(spark.read.parquet(store))
    D.score_days(rows, root, store, days[25], days[25], COLUMNS)
    after = files()
    changed = {f.split("/")[-2] for f, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"{C.SNAPSHOT}={days[25]}"} and table(spark.read.parquet(store)) == old


def test_versions_needed(spark, stored):
    root, rows, days, pairs = stored
    found = lambda a, b: [v.day for v in D.load_versions(spark, root, a, b)]
    assert found(days[0], days[5]) == [] and found(days[12], days[13]) == [days[10]]
    assert found(days[0], days[39]) == [days[10], days[25]] and found(days[25], days[39]) == [days[25]]
    with pytest.raises(RuntimeError):
        with S.ready_version(spark, root, D.PAIR, days[28]):
            raise RuntimeError("lost")
    assert found(days[30], days[39]) == [days[25]]
    nothing = D.explain_by_version(rows, [], {C.PROMOTER: "_prom"})
    assert nothing.where("model_version IS NULL AND out_value_prom IS NULL").count() == rows.count()
    assert D.explain_by_version(rows.limit(0), D.load_versions(spark, root, days[0], days[39]), {C.PROMOTER: "_prom"}).count() == 0


def test_registered_query(inputs):
    from satlens.plans.q_ml import q_score_daily
    got = q_score_daily(inputs)
    assert got.count() == inputs.model_input.count()
    assert {r[0] for r in got.select("model_version").distinct().collect()} == {None, "1997-01-01", "2000-01-01"}
