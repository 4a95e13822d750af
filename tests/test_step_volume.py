"""What the shared steps move: rows shuffled once, small tables broadcast, and the same results."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import metrics as M, models, split as SP, uncertainty as U
from satlens.operators.windows import dedup_first
from satlens.plans import etl, q_ml, registry
from satlens.session import RUNTIME_FILTERS, runtime_filters
from satlens.sources import testdata as td

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def physical(spark):
    """The physical plan without adaptive changes and without joins by size."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


def tables(spark, at, numbers):
    """Orders 1 to 40 with lines of the given numbers; every third line comes twice, the second time with another price."""
    day = dt.datetime(1997, 3, 1)
    spark.createDataFrame([(i, i % 25) for i in range(5)], "c_custkey long, c_nationkey int").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(k, k % 6, "OF"[k % 2], day + dt.timedelta(days=31 * k), "1-A") for k in range(1, 41)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(
        f"{at}/orders.parquet")
    lines = []
    for k in range(1, 41):
        for ln in numbers:
            line = (k, 11 * k + 1, None if k % 9 == 0 else k % 7, ln, float(k % 50), 100.0 * k, 0.05, 0.02, "ANR"[k % 3])
            lines += [line, (*line[:5], 50.0 * k, *line[6:])] if k % 3 == 0 else [line]
    spark.createDataFrame(lines, LINE).write.parquet(f"{at}/lineitem.parquet")


@pytest.mark.parametrize("numbers, apart", [([1, 2], True), ([1, 11, 21], False), ([None, 1], False)])
def test_model_input_keeps_the_rows_of_joining_first(spark, tmp_path, numbers, apart):
    tables(spark, tmp_path, numbers)
    at = str(tmp_path)
    assert td.ids_hold_one_order(spark, at) == apart
    joined = etl.join_load_factor(etl.clean_survey(td.survey(spark, at)), etl.clean_load_factor(td.load_factor(spark, at)))
    want = dedup_first(joined, [C.ID], etl.DEDUP_ORDER).select(*etl.MODEL_COLUMNS)
    got = registry.Inputs(spark, at, materialize=False).model_input
    assert got.count() > 5 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_least_load_factor_of_several_rows_a_key(spark, tmp_path):
    tables(spark, tmp_path, [1])
    survey, lf = td.survey(spark, str(tmp_path)), td.load_factor(spark, str(tmp_path))
    twice = lf.unionByName(lf.withColumns({c: F.col(c) / 2 for c in lf.columns if c.startswith("pax_")}))
    joined = etl.join_load_factor(etl.clean_survey(survey), etl.clean_load_factor(twice))
    want = dedup_first(joined, [C.ID], etl.DEDUP_ORDER).select(*etl.MODEL_COLUMNS)
    assert sorted(etl.model_input(survey, twice).collect(), key=str) == sorted(want.collect(), key=str)


def test_keeping_first_moves_no_row_again(spark, tmp_path, physical):
    tables(spark, tmp_path, [1, 2])
    text = physical(registry.Inputs(spark, str(tmp_path), materialize=False).model_input)
    assert "hashpartitioning(respondent_id" not in text and "hashpartitioning(l_orderkey" in text


def test_runtime_filters_are_of_the_step_only(spark):
    name = "spark.sql.optimizer.runtime.bloomFilter.numBits"
    before = {k: spark.conf.get(k, None) for k in RUNTIME_FILTERS}
    with pytest.raises(ZeroDivisionError), runtime_filters(spark):
        assert spark.conf.get(name) == RUNTIME_FILTERS[name]
        1 / 0
    assert {k: spark.conf.get(k, None) for k in RUNTIME_FILTERS} == before


def test_ranks_shuffle_rows_once_without_their_hash(spark, physical):
    d = spark.range(500).select(F.col("id").alias(C.ID), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.lit("x").alias("payload"))
    t = SP.stratified_rank(d, ["g"], seed=4)
    moved = [line for line in physical(t).splitlines() if "Exchange hashpartitioning(__at" in line and "REPARTITION_BY_COL" in line]
    assert len(moved) == 1 and physical(t).count("Exchange hashpartitioning") <= 5
    ranks = {}
    for r in sorted(t.collect(), key=lambda r: (str(r.g), r.__getitem__("__h"), r[C.ID])):
        ranks.setdefault(r.g, []).append((r["__rank"], r["__n"]))
    assert all(v == [(i, len(v)) for i in range(1, len(v) + 1)] for v in ranks.values()) and len(ranks) == 3


def test_metrics_count_scores_once(spark, physical):
    nan = float("nan")
    rows = [("a", 1, 0.9), ("a", 0, 0.9), ("a", 1, 0.2), ("a", None, 0.7), ("a", 0, None), ("a", 1, nan), ("b", None, 0.4), (None, 1, 0.6), (None, 0, 0.1)]
    d = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.g: (r.tp, r.fp, r.fn, r.tn, r.auc) for r in M.binary_metrics(d, "y", "s", ["g"]).collect()}
    assert got == {"a": (2, 1, 1, 0, 0.25), "b": (0, 0, 0, 0, None), None: (1, 0, 0, 1, 1.0)}  # NaN is above all numbers; it has no rank
    whole = M.binary_metrics(d, "y", "s").first()
    assert (whole.tp, whole.fp, whole.fn, whole.tn) == (3, 1, 1, 1) and math.isclose(whole.auc, 2.5 / 6 + 1 / 6)
    assert M.binary_metrics(d.where("false"), "y", "s").first()[:4] == (0, 0, 0, 0)
    text = physical(M.binary_metrics(d, "y", "s", ["g"]))
    assert "partial_count_if((y" in text and "partial_count_if(((" not in text  # nothing but (group, score) is counted over the rows


def test_samples_drop_rows_before_a_shuffle(spark, physical):
    d = spark.range(20_000).select(F.col("id").alias(C.ID), F.rand(1).alias(U.PRED), F.rand(2).alias(U.UNC))
    top = U.hash_top_n(d.withColumn("g", F.col(C.ID) % 2), ["g"], C.ID, 3, 7)
    assert "BroadcastHashJoin" in physical(top) and "SortMergeJoin" not in physical(top)
    every = d.withColumns({"g": F.col(C.ID) % 2, "h": U.hash_order(C.ID, 3)}).collect()
    want = {(g, i, r[C.ID]) for g in (0, 1) for i, r in enumerate(sorted((r for r in every if r.g == g), key=lambda r: (r.h, r[C.ID]))[:7], 1)}
    assert {(r.g, r.rn, r[C.ID]) for r in top.collect()} == want


def test_gate_splits_once(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path, [1, 2])
    seen = []

    def fit(rows, **_):
        seen.append(rows)
        raise InterruptedError

    monkeypatch.setattr(models, "train_pair", fit)
    with pytest.raises(InterruptedError):
        q_ml.q_champion_gate(registry.Inputs(spark, str(tmp_path)))
    assert "Window" not in plan(seen[0]) and {"split", *C.FEATURES, *C.LABELS} == set(seen[0].columns)
