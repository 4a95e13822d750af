"""NULL keys are groups like any other: no operator loses their rows."""

import pytest
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import clean, explain, features, joins, metrics, split, stats, uncertainty


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, None if i % 4 == 0 else "ab"[i % 2], float(i % 7), i % 3 % 2, (i % 10) / 10) for i in range(20)]
    return spark.createDataFrame(data, f"{C.ID} long, g string, v double, y int, p double")


def test_splits_keep_all_rows(rows):
    for out in (split.split_stratified(rows, ["g"], 0.2, 0.2), split.kfold_ids(rows, 3, ["g"]), split.class_weights(rows, "g")):
        assert out.count() == 20
    assert split.split_stratified(rows, ["g"], 0.2, 0.2).where("g is null").select("split").distinct().count() == 3
    assert split.class_weights(rows, "g").where("weight is null").count() == 0
    assert split.undersample(rows, "g").where("g is null").count() == 5


def test_group_statistics_keep_the_null_group(rows):
    q = {r["g"]: r["q_50"] for r in stats.exact_quantiles(rows, "v", [0.5], ["g"]).collect()}
    want = sorted(float(i % 7) for i in range(0, 20, 4))[2]
    assert set(q) == {None, "a", "b"} and q[None] == want
    m = {r["g"]: r["auc"] for r in metrics.binary_metrics(rows, "y", "p", ["g"]).collect()}
    assert set(m) == {None, "a", "b"} and m[None] is not None


def test_samples_keep_the_null_group(rows):
    top = uncertainty.hash_top_n(rows, ["g"], C.ID, 1, 2)
    assert top.where("g is null").count() == 2


def _expl(spark):
    return spark.createDataFrame([(p, s, "SH", f, j, v, 1.0, 0.5, 0.6, 60.0) for p in (1, 2) for s in ("Economy", None)
                                  for j, (f, v) in enumerate((("x", 1.0), ("z", -2.0)))],
                                 f"{explain.PERIOD} int, {C.CABIN} string, {C.HAUL} string, feature string, position int, value double, "
                                 "data double, base_value double, prediction_frac double, prediction_pct double")


def test_explanations_keep_null_segments(spark):
    e = _expl(spark)
    actual = e.select(explain.PERIOD, C.CABIN, C.HAUL).distinct().withColumn("actual", F.lit(55.0))
    assert explain.adjust_to_actual(e, actual).count() == e.count()
    assert explain.explain_vs_base(e, 1).count() == e.count()
    assert explain.nps_mae(e, actual).count() == 2


def test_join_counts_match_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, x int")
    right = spark.createDataFrame([(None, 5), ("a", 6), ("b", 7)], "k string, x int")
    r = joins.join_fanout(left, right, ["k"]).first()
    assert (r["n_keys"], r["n_pairs"], r["max_pairs_per_key"]) == (2, 3, 2)
    assert sorted(map(str, joins.resolve_suffix(left, right, ["k"]).collect())) == sorted(
        ["Row(k=None, x=1)", "Row(k=None, x=2)", "Row(k='a', x=3)"])


def test_small_samples_report_what_was_drawn(spark):
    df = spark.createDataFrame([(i, i / 10, 0.1, i % 11) for i in range(40)],
                               f"{C.ID} long, out_prob_nps double, uncertainty_nps double, {C.SCORE} int")
    s = uncertainty.sample_uncertainty(df, 2, 100).collect()
    sd = df.agg(F.stddev_samp("out_prob_nps")).first()[0]
    assert all(r["n"] == 40 and r["sem"] == pytest.approx(sd / 40**0.5) for r in s)
    c = {r["sample_size"]: r for r in uncertainty.uncertainty_curve(df, [10, 40, 50]).collect()}
    assert set(c) == {10, 40, 50} and c[50]["n_rows"] == 40 and c[50]["sem"] is None and c[40]["sem"] == pytest.approx(sd / 40**0.5)


def test_casts_lose_nothing(spark):
    df = spark.createDataFrame([(1, 70000, 2.5, 1e300, 2**62), (2, -1, float("nan"), 1.0, None)], "a long, b long, c double, d double, e long")
    out = clean.cast_types(df)
    assert dict(out.dtypes) == {"a": "smallint", "b": "bigint", "c": "float", "d": "double", "e": "bigint"}
    assert out.first()["b"] == 70000 and out.first()["d"] == 1e300 and out.first()["e"] == 2**62
    assert dict(clean.cast_types(df.limit(0)).dtypes)["b"] == "smallint"


def test_issue_columns_are_those_of_the_table(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None)], "id int, late string, cold string")
    d = spark.createDataFrame([("food", "cold"), ("crew", "late"), ("crew", "cold"), ("crew", "unknown"), (None, "late"), ("food", None)],
                              "associated_touchpoint string, issue_type_2 string")
    r = features.issue_flags(df, d).orderBy("id").collect()
    assert [(x["late"], x["cold"], x["issues_food"], x["issues_crew"]) for x in r] == [(1, 0, 0, 1), (0, 0, 0, 0)]
