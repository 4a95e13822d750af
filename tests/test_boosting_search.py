"""Early stopping by truncation, kept models and the halving search."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import boosting, models, search
from satlens.operators import split as SP
from satlens.operators import trees as TR
from satlens.plans import catalog
from satlens.plans.registry import runner

PARAMS = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.4, "seed": 0}


@pytest.fixture(scope="module")
def folds(spark, inputs):
    return SP.kfold_ids(inputs.model_input, 2, [C.PROMOTER], seed=1).select(C.ID, "fold", *C.FEATURES, *C.LABELS).cache()


@pytest.fixture(scope="module")
def kept(folds):
    return boosting.cross_validate(folds, k=2, params=PARAMS)


def test_nodes_equal_the_saved_form(spark, inputs):
    model = models.train_pair(inputs.model_input, labels=[C.PROMOTER], params=PARAMS)[C.PROMOTER]
    rows = inputs.model_input.select(C.ID, *C.FEATURES)
    both = TR.score(TR.score(rows, boosting.node_trees(model), C.FEATURES, "a"), TR.read_trees(spark, model), C.FEATURES, "b")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_losses_equal_models_of_fewer_rounds(folds, kept):
    for m in kept:
        assert len(m.losses) == 5 and m.best_round == 1 + int(np.argmin(m.losses))
        rows = folds.where(F.col("fold") == m.fold)
        eps = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
        loss = TR.score(rows, m.trees, C.FEATURES, "p").agg(F.avg(F.when(F.col(m.label) == 1, -F.log(eps)).otherwise(-F.log(1 - eps)))).first()[0]
        assert loss == pytest.approx(m.losses[m.best_round - 1], abs=1e-9)
    assert sorted((m.label, m.fold) for m in kept) == sorted((lab, f) for lab in C.LABELS for f in range(2))


def test_held_out_scores_use_the_other_folds_model(folds, kept):
    scored = boosting.held_out_scores(folds, kept)
    for m in kept:
        want = TR.score(scored.where(F.col("fold") == m.fold), m.trees, C.FEATURES, "p")
        assert want.where((F.abs(F.col("p") - F.col(f"p_{m.label}")) > 1e-12) | F.isnan(f"p_{m.label}")).count() == 0


def test_refit_has_the_median_round(folds, kept):
    for label, model in boosting.refit(folds, kept, params=PARAMS).items():
        assert model.getNumTrees == int(np.median([m.best_round for m in kept if m.label == label]))


def test_best_round_and_patience():
    losses = np.array([5.0, 4.0, 4.5, 4.6, 3.0])
    assert boosting.best_round(losses) == 5 and boosting.best_round(losses, 2) == 2 and boosting.best_round(losses, 3) == 5
    assert boosting.best_round(np.array([np.inf])) == 1


def test_draws_are_seeded_nested_and_in_range():
    assert search.draws(50, 3)[:20] == search.draws(20, 3) != search.draws(20, 4)
    steps = []
    for point in search.draws(300, 1):
        steps.append(point["stepSize"])
        assert all(low <= point[n] <= high for n, (_, low, high) in search.SPACE.items())
    assert {p["maxDepth"] for p in search.draws(300, 1)} == {2, 3, 4, 5}
    assert abs(np.median(np.log(steps)) - np.log(0.1)) < 0.3  # half of the draws below the middle of the scale


def test_search_halves_and_resumes(spark, folds, tmp_path, monkeypatch):
    run = lambda: search.search(folds, labels=[C.PROMOTER], k=2, trials=6, seed=5, rungs=((0.3, 1), (1.0, 3)), table=f"{tmp_path}/trials")
    fits = []
    plain = search.node_trees
    monkeypatch.setattr(search, "node_trees", lambda m: fits.append(1) or plain(m))
    first, best = run()
    assert len(fits) == 6 + 2 * 2  # six points, then the best third in every fold
    rows = first.collect()
    order = sorted((r["log_loss"], r["trial"]) for r in rows if r["rung"] == 0)
    assert {r["trial"] for r in rows if r["rung"] == 1} == {t for _, t in order[:2]}
    won = min((r for r in rows if r["rung"] == 1), key=lambda r: (r["log_loss"], r["trial"]))
    assert best[C.PROMOTER] == {**search.draws(6, 5)[won["trial"]], "maxIter": won["best_round"]}
    again, same = run()
    assert len(fits) == 10 and same == best and sorted(again.collect()) == sorted(rows)  # nothing is fitted twice


def test_search_query(spark, monkeypatch):
    """The registered query, with a quarter of its points."""
    from satlens.plans import q_ml
    catalog.load()
    whole = q_ml.search.search
    monkeypatch.setattr(q_ml.search, "search", lambda d, **kw: whole(d, **{**kw, "trials": 6}))
    rows = runner("param_search")(spark, "/root/testdata/sf0.001").collect()
    assert sum(r["best"] for r in rows) == 2 and {r["label"] for r in rows} == set(C.LABELS)


def test_window_uses_its_own_days_only(inputs):
    start, end = dt.date(1996, 1, 1), dt.date(1998, 1, 1)
    inside = inputs.model_input.where((F.col(C.DATE) >= F.lit(start)) & (F.col(C.DATE) < F.lit(end)))
    one, two = (boosting.train_window(d, start, end, labels=[C.PROMOTER], k=2, params=PARAMS) for d in (inputs.model_input, inside))
    assert [m.losses.tolist() for m in one.kept] == [m.losses.tolist() for m in two.kept] and len(one.kept) == 2
    assert one.models[C.PROMOTER].getNumTrees == int(np.median([m.best_round for m in one.kept]))
    n = inside.count()
    got = one.rows.groupBy("split", F.col("fold").isNull().alias("none")).count().collect()
    assert {(r["split"], r["none"]) for r in got} == {("train", False), ("test", True)} and sum(r["count"] for r in got) == n
    assert one.rows.select(C.ID).distinct().count() == n


def test_the_registered_window_run_reports_held_out_rows(spark):
    catalog.load()
    got = runner("train_window")(spark, "/root/testdata/sf0.001").collect()
    assert {r["split"] for r in got} == {"train", "test", "held out"} and {r["label"] for r in got} == set(C.LABELS)
    assert all(1 <= r["rounds"] <= 30 for r in got)
