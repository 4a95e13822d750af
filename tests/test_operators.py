"""Joins, audits, quantiles, ranks, AUC and partition resolution against brute force."""

import datetime as dt
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from satlens.operators import joins, metrics, split, stats
from satlens.sources import files as FS


def test_null_keys_match_once(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(None, 10.0), (2, 20.0)], "k int, r double")
    got = sorted((r.l, r.r) for r in joins.left_join_null_safe(left, right, ["k"]).collect())
    assert got == [("a", 10.0), ("b", None)]


def test_join_audit_matches_pairs(spark):
    rnd = random.Random(3)
    a = [(rnd.randint(0, 6),) for _ in range(40)]
    b = [(rnd.randint(3, 9),) for _ in range(30)]
    got = {r.merge_side: r.n_rows for r in joins.join_audit(
        spark.createDataFrame(a, "k int"), spark.createDataFrame(b, "k int"), ["k"]).collect()}
    ka, kb = [x[0] for x in a], [x[0] for x in b]
    both = sum(1 for x, y in product(ka, kb) if x == y)
    assert got.get("both", 0) == both
    assert got.get("left_only", 0) == sum(1 for x in ka if x not in kb)
    assert got.get("right_only", 0) == sum(1 for y in kb if y not in ka)


def test_snapshot_diff_null_safe(spark):
    today = spark.createDataFrame([(1, None, "d2"), (2, 5, "d2"), (3, 6, "d2")], "id int, v int, stamp string")
    yday = spark.createDataFrame([(1, None, "d1"), (2, 4, "d1")], "id int, v int, stamp string")
    got = sorted(r.id for r in joins.snapshot_diff(today, yday, ["stamp"]).collect())
    assert got == [2, 3]


@pytest.mark.parametrize("probs", [[0.5], [0.05, 0.5, 0.85, 0.95], [0.0, 1.0]])
def test_exact_quantiles_vs_numpy(spark, probs):
    rnd = np.random.default_rng(0)
    vals = np.round(rnd.normal(size=301), 1)        # many ties
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "x double, g int")
    q = stats.exact_quantiles(df, "x", probs, ["g"]).collect()
    for r in q:
        sub = vals[np.arange(len(vals)) % 3 == r.g]
        for p, name in zip(probs, [c for c in r.asDict() if c.startswith("q_")]):
            assert r[name] == pytest.approx(np.quantile(sub, p), abs=1e-12)


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, 3), (1, 2), (1, 7)], "b int, x int")
    r = stats.binned_mean_mode(df, F.col("b"), ["x"]).first()
    assert r.mode_x == 2


def test_auc_ties_average_ranks(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = metrics.auc(df, "y", "s").first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    u = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    assert got == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)


def test_stratified_rank_is_row_number(spark):
    rows = [(i, i % 4) for i in range(500)]
    df = spark.createDataFrame(rows, "respondent_id long, g int")
    t = split.stratified_rank(df, ["g"], "respondent_id", seed=9, bucket_hex_digits=1)
    w = __import__("pyspark.sql", fromlist=["Window"]).Window
    ref = df.withColumn("h", split.seeded_hash("respondent_id", 9)).withColumn(
        "rn", F.row_number().over(w.partitionBy("g").orderBy("h", "respondent_id")))
    a = {r.respondent_id: r["__rank"] for r in t.select("respondent_id", "__rank").collect()}
    b = {r.respondent_id: r.rn for r in ref.collect()}
    assert a == b


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(1000)], "respondent_id long, g int")
    got = {(r.g, r.split): r.n for r in split.split_stratified(df, ["g"], 0.2, 0.2)
           .groupBy("g", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[(0, "test")] == 100 and got[(0, "val")] == 80 and got[(0, "train")] == 320


def test_partition_asof_and_parse(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 5, 9)], "p date, v int")
    one = [r.v for r in FS.partition_asof(df, "p", dt.date(2024, 1, 6), 1).collect()]
    two = [r.v for r in FS.partition_asof(df, "p", dt.date(2024, 1, 6), 2).collect()]
    none = FS.partition_asof(df, "p", dt.date(2023, 12, 31), 1).count()
    assert one == [5] and two == [1] and none == 0
    t = spark.createDataFrame([("insert_date_ci=2024-01-02",), ("20240102",), ("2024-01-02",), ("x",)], "t string")
    got = [r[0] for r in t.select(FS.parse_partition_date(F.col("t"))).collect()]
    assert got == [dt.date(2024, 1, 2)] * 3 + [None]
