"""Tree SHAP against brute-force Shapley enumeration; native scoring and the
virtual ensemble against MLlib."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import models
from satlens.operators import trees as TR
from satlens.operators import treeshap as TS


def _tree(weight, spec):
    """spec: nested tuples (feature, threshold, left, right) or leaf floats; covers given."""
    t = TR.Tree(weight=weight)
    counter = [0]

    def add(node, cover):
        nid = counter[0]
        counter[0] += 1
        if isinstance(node, tuple):
            f, thr, (l, lc), (r, rc) = node
            n = TR.Node(nid, 0.0, cover, f, thr)
            t.nodes[nid] = n
            n.left = add(l, lc)
            n.right = add(r, rc)
        else:
            t.nodes[nid] = TR.Node(nid, float(node), cover)
        return nid

    add(spec, 100.0)
    return t


def _value(trees, x, S):
    """Path-dependent expectation with features S known."""
    def rec(t, nid):
        n = t.nodes[nid]
        if n.is_leaf:
            return n.prediction
        if n.feature in S:
            return rec(t, n.left if x[n.feature] <= n.threshold else n.right)
        l, r = t.nodes[n.left], t.nodes[n.right]
        return (l.cover * rec(t, n.left) + r.cover * rec(t, n.right)) / n.cover
    return sum(2 * t.weight * rec(t, t.root) for t in trees)


def _brute(trees, x, nf):
    phi = np.zeros(nf)
    for i in range(nf):
        others = [j for j in range(nf) if j != i]
        for k in range(nf):
            for S in combinations(others, k):
                w = factorial(k) * factorial(nf - k - 1) / factorial(nf)
                phi[i] += w * (_value(trees, x, set(S) | {i}) - _value(trees, x, set(S)))
    return phi


def test_tree_shap_equals_brute_force():
    # repeated features on a path and unequal covers
    t1 = _tree(1.0, (0, 0.5, ((1, 0.3, (1.0, 20.0), (2.0, 40.0)), 60.0),
                     ((0, 0.8, (3.0, 10.0), (-1.0, 30.0)), 40.0)))
    t2 = _tree(0.3, (2, 0.0, ((3, 1.0, (0.5, 5.0), (-0.5, 45.0)), 50.0),
                     ((4, 2.0, (1.5, 25.0), ((5, 0.1, (0.2, 10.0), (0.9, 15.0)), 25.0)), 50.0)))
    trees = [t1, t2]
    rng = np.random.default_rng(1)
    X = rng.normal(size=(12, 6))
    leaves, base = TS.compile_model(trees)
    phi = TS.shap_batch(X, leaves, base)
    for row, p in zip(X, phi):
        assert np.allclose(p, _brute(trees, row, 6), atol=1e-10)
        assert p.sum() + base == pytest.approx(_value(trees, row, set(range(6))), abs=1e-10)


def test_gbt_native_scoring_shap_and_ensemble(spark, inputs):
    mi = inputs.model_input
    fitted = models.train_pair(mi, params={"maxIter": 6, "maxDepth": 3, "stepSize": 0.3, "seed": 0})
    m = fitted[C.PROMOTER]
    trees = TR.read_trees(spark, m)
    a = models.assemble(mi, C.FEATURES)
    cmp = TR.score(models.probability(a, m, "p_ml"), trees, C.FEATURES, "p_nat")
    assert cmp.agg(F.max(F.abs(F.col("p_ml") - F.col("p_nat")))).first()[0] < 1e-12
    sh = TR.margins(TS.tree_shap(mi, trees, C.FEATURES, "_prom"), {"m": trees}, C.FEATURES)
    assert sh.agg(F.max(F.abs(F.col("out_value_prom") - F.col("m")))).first()[0] < 1e-9
    ve = TR.virtual_ensemble(mi, trees, C.FEATURES, 1, "_prom")
    r = ve.agg(F.min("mean_proba_prom"), F.max("mean_proba_prom"), F.min("uncertainty_prom")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] >= 0.0


def test_nan_is_missing_and_large_ids_survive(spark):
    """NaN in a non-nullable column scores, explains and imputes like NULL; other columns pass through bit for bit."""
    from pyspark.sql import types as T
    tree = _tree(0.7, (0, 0.5, ((1, 0.3, (1.0, 20.0), (2.0, 40.0)), 60.0), (3.0, 40.0)))
    ids = [2**53 + 1, 2**62 + 3, -5, 7]
    rows = [(ids[0], float("nan"), 1.0, None), (ids[1], 0.2, 0.1, 2**53 + 1), (ids[2], 0.9, float("nan"), 3), (ids[3], -1e8, 1.0, 4)]
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("a", T.DoubleType(), False),
                           T.StructField("b", T.DoubleType(), False), T.StructField("n", T.LongType(), True)])
    df = spark.createDataFrame(rows, schema)
    out = TR.score(TS.explain_many(df, {"_x": [tree]}, ["a", "b"], ensemble_step=1), [tree], ["a", "b"], "p").collect()
    as_null = spark.createDataFrame([(i, None if a != a else a, None if b != b else b, n) for i, a, b, n in rows], "id long, a double, b double, n long")
    same = TR.score(TS.explain_many(as_null, {"_x": [tree]}, ["a", "b"], ensemble_step=1), [tree], ["a", "b"], "p").collect()
    assert [(r["id"], r["n"]) for r in out] == [(r[0], r[3]) for r in rows]
    for r, q, x in zip(out, same, ([-1e9, 1.0], [0.2, 0.1], [0.9, -1e9], [-1e8, 1.0])):
        want = _value([tree], x, {0, 1})
        assert r["out_value_x"] == pytest.approx(want) and r["p"] == pytest.approx(1 / (1 + np.exp(-want)))
        assert all(r[c] == q[c] for c in ("a_x", "b_x", "out_value_x", "p", "mean_proba_x", "uncertainty_x"))


def test_many_trees_keep_the_plan_small(spark, inputs):
    tree = _tree(0.1, (0, 50.0, ((1, 0.3, (1.0, 20.0), (2.0, 40.0)), 60.0), (-1.0, 40.0)))
    few = TR.virtual_ensemble(inputs.model_input, [tree] * 10, C.FEATURES, 5, "_p")
    many = TR.virtual_ensemble(inputs.model_input, [tree] * 240, C.FEATURES, 5, "_p")
    size = lambda df: len(df._jdf.queryExecution().toString())
    assert size(many) < 1.2 * size(few)
    r = many.agg(F.min("uncertainty_p"), F.max("mean_proba_p")).first()
    assert r[0] >= 0 and r[1] <= 1


def test_registered_ensembles_are_uncertain(inputs):
    """The registered pair has trees enough for several truncated models at the registered step."""
    from satlens.plans import q_ml
    r = q_ml.q_virtual_ensemble(inputs).agg(F.max("uncertainty_prom"), F.max("uncertainty_det"),
                                            F.avg((F.col("uncertainty_prom") > 0).cast("int"))).first()
    assert r[0] > 0 and r[1] > 0 and r[2] > 0.99
    assert q_ml.q_predict_explain(inputs).agg(F.max("uncertainty_nps")).first()[0] > 0
    assert q_ml.q_score_quarters(inputs).agg(F.min("mean_uncertainty_nps")).first()[0] > 0
