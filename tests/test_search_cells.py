"""Rungs of many rows are fitted on parts of cells; a point means the same there."""

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import boosting, models, search
from satlens.operators import split as SP
from satlens.operators import trees as TR

POINT = {"maxIter": 3, "maxDepth": 4, "stepSize": 0.4, "minInstancesPerNode": 40, "seed": 0}


@pytest.fixture(scope="module")
def rows(spark, inputs):
    """Four times the model input, one respondent's answers 3,000 times more."""
    d = inputs.model_input.select(C.ID, *C.FEATURES, *C.LABELS)
    copies = d.withColumn("copy", F.explode(F.array(*map(F.lit, range(4)))))
    heavy = d.orderBy(C.ID).limit(1).withColumn("copy", F.explode(F.sequence(F.lit(4), F.lit(3003))))
    d = copies.unionByName(heavy).withColumn(C.ID, F.xxhash64(C.ID, "copy")).drop("copy")
    return SP.kfold_ids(d, 3, [C.PROMOTER], seed=1).cache()


def test_parts_hold_every_row_shown_once_and_none_is_heavy(rows):
    with search.fit_input(rows, C.FEATURES, C.LABELS, range(3), 4, 100) as (data, shown):
        got = data.groupBy(*C.LABELS).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"_w{f}").alias(f"w{f}") for f in range(3)]).collect()
        most = data.agg(F.max(F.greatest(*[F.col(f"_w{f}") for f in range(3)]))).first()[0]
        assert data.where(F.col("_w0") != F.floor("_w0")).count() == 0
    want = {tuple(r[lab] for lab in C.LABELS): r for r in rows.groupBy(*C.LABELS).agg(
        *[F.count_if(F.col("fold") != f).alias(f"w{f}") for f in range(3)]).collect()}
    assert len(got) == len(want) and all(r[f"w{f}"] == want[tuple(r[lab] for lab in C.LABELS)][f"w{f}"] for r in got for f in range(3))
    n, parts = rows.count(), sum(r["n"] for r in got)
    assert shown == {f: sum(r[f"w{f}"] for r in want.values()) for f in range(3)}
    assert parts < n / 2 and most <= n / parts * 2 + 1  # the heavy cell is dealt out


def test_a_leaf_holds_the_points_least_number_of_rows(rows):
    base = rows.select("fold", *TR.filled(C.FEATURES), *C.LABELS)
    binned = models.nearest(base, models.bin_values(base, C.FEATURES))
    plain = models.gbt(C.PROMOTER, POINT).fit(models.assemble(binned.where("fold != 1"), C.FEATURES))
    with search.fit_input(rows, C.FEATURES, C.LABELS, [1], 4, 100) as (data, shown):
        fitted = models.gbt(C.PROMOTER, search.by_weight(POINT, shown[1]), "_w1").fit(data.where("_w1 > 0"))
    trees = boosting.node_trees(fitted)
    assert min(n.cover for t in trees for n in t.nodes.values() if n.is_leaf) >= 40
    both = TR.score(TR.score(rows, boosting.node_trees(plain), C.FEATURES, "a"), trees, C.FEATURES, "b")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    assert search.by_weight(POINT, 79)["maxDepth"] == 0  # two leaves of 40 need 80 rows


def test_a_search_on_cells_judges_like_one_on_rows(rows, monkeypatch):
    seen = []
    plain = search.by_weight
    monkeypatch.setattr(search, "by_weight", lambda point, n: seen.append(n) or plain(point, n))
    run = lambda: search.search(rows, labels=[C.PROMOTER], k=3, trials=3, seed=5, rungs=((0.3, 2), (1.0, 3)))
    on_rows, best = run()
    assert not seen
    monkeypatch.setattr(search.fit_input.__wrapped__, "__defaults__", (1000,))
    on_cells, same = run()
    n = rows.count()
    assert len(seen) == 3 + 1 * 3 and sorted(seen[3:]) == sorted(rows.where(F.col("fold") != f).count() for f in range(3)) and max(seen[:3]) < n / 2
    near = {(r["trial"], r["rung"]): r["log_loss"] for r in on_rows.collect()}
    for r in on_cells.collect():
        assert r["log_loss"] == pytest.approx(near[r["trial"], r["rung"]], abs=0.03)
    assert {k: v for k, v in same[C.PROMOTER].items() if k != "maxIter"} == {k: v for k, v in best[C.PROMOTER].items() if k != "maxIter"}
