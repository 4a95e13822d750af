"""Fits on cells: rows with equal bins and labels count as one row with their weight."""

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import boosting, models
from satlens.operators import split as SP
from satlens.operators import trees as TR

PARAMS = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.4, "seed": 0}


@pytest.fixture(scope="module")
def rows(spark, inputs):
    """Twice the model input, so that cells hold several rows, with a NaN price."""
    d = inputs.model_input.select(C.ID, *C.FEATURES, *C.LABELS)
    d = d.withColumn("ticket_price", F.when(F.col(C.ID) % 50 == 0, float("nan")).otherwise(F.col("ticket_price")))
    d = d.unionByName(d.withColumn(C.ID, -F.col(C.ID)))
    return SP.kfold_ids(d, 3, [C.PROMOTER], seed=1).cache()


def test_cells_hold_every_row_once(rows):
    shown = {f"w{f}": (F.col("fold") != f).cast("double") for f in range(3)}
    with models.cells(rows, C.FEATURES, C.LABELS, {"w": F.lit(1.0), **shown}, all_rows=100) as data:
        got = data.groupBy(*C.LABELS).agg(F.count(F.lit(1)).alias("cells"), *[F.sum(c).alias(c) for c in ("w", *shown)]).collect()
    want = {tuple(r[lab] for lab in C.LABELS): r for r in rows.groupBy(*C.LABELS).agg(
        F.count(F.lit(1)).alias("w"), *[F.count_if(F.col("fold") != f).alias(f"w{f}") for f in range(3)]).collect()}
    for r in got:
        assert all(r[c] == want[tuple(r[lab] for lab in C.LABELS)][c] for c in ("w", "w0", "w1", "w2"))
    assert len(got) == len(want) and sum(r["cells"] for r in got) <= rows.count() / 2


def test_values_of_a_feature(spark):
    d = spark.range(4000).select((F.col("id") % 3).cast("double").alias("few"), F.col("id").cast("double").alias("many"),
                                 F.when(F.col("id") < 3000, 7.0).otherwise(F.col("id").cast("double")).alias("heavy"),
                                 F.when(F.col("id") == 5, 1.0).otherwise(0.0).alias("rare"), F.lit(2.5).alias("one"))
    found = models.bin_values(d, d.columns)
    assert found["few"] == [0.0, 1.0, 2.0] and found["rare"] == [0.0, 1.0] and found["one"] == [2.5]
    assert len(found["many"]) <= models.CELL_VALUES and found["many"][0] == 0.0 and found["many"][-1] == 3999.0
    assert 7.0 in found["heavy"] and 20 < len(found["heavy"]) <= models.CELL_VALUES


def test_a_fit_on_cells_is_that_on_the_binned_rows(spark, rows, monkeypatch):
    base = rows.select(C.ID, "fold", *TR.filled(C.FEATURES), *C.LABELS)
    binned = models.nearest(base, models.bin_values(base, C.FEATURES))
    plain = models.gbt(C.PROMOTER, PARAMS).fit(models.assemble(binned, C.FEATURES))
    monkeypatch.setattr(models.cells.__wrapped__, "__defaults__", (100,))
    fitted = models.train_pair(rows, labels=[C.PROMOTER], params=PARAMS)[C.PROMOTER]
    both = lambda d: TR.score(TR.score(d, boosting.node_trees(plain), C.FEATURES, "a"),
                              TR.read_trees(spark, fitted), C.FEATURES, "b")
    assert both(rows).where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    # thresholds lie between the values, so rows and binned rows take the same way
    real, rounded = both(rows).select(C.ID, "b"), both(binned).select(F.col(C.ID).alias("i"), F.col("b").alias("c"))
    assert real.join(rounded, F.col(C.ID) == F.col("i")).where(F.abs(F.col("b") - F.col("c")) > 1e-12).count() == 0
    # covers are rows, not cells
    covers = [t.nodes[t.root].cover for t in TR.read_trees(spark, fitted)]
    assert covers == [rows.count()] * len(covers) == [t.nodes[t.root].cover for t in boosting.node_trees(fitted)]


def test_folds_on_cells_do_not_see_the_rows_held_out(rows, monkeypatch):
    monkeypatch.setattr(models.cells.__wrapped__, "__defaults__", (100,))
    kept = boosting.cross_validate(rows, labels=[C.PROMOTER], k=3, params=PARAMS)
    for m in kept:
        assert m.trees[0].nodes[m.trees[0].root].cover == rows.where(F.col("fold") != m.fold).count()
