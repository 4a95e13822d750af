"""The survey view: lines are joined, and so moved, once."""

import datetime as dt

from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import trees as TR
from satlens.sources import testdata as td


def test_customers_meet_the_orders_not_the_lines(spark, tmp_path):
    day = dt.datetime(1996, 5, 1)
    spark.createDataFrame([(1, 0), (1, 1), (2, 2), (None, 3)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(10, 1, "O", day, "1-A"), (11, 2, "F", day, "2-B"), (11, 2, "F", day, "2-B"), (12, None, "O", day, "1-A"), (13, 9, "O", day, "1-A")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 5, 3, 1, 20.0, 100.0, 0.05, 0.02, "A") for k in (10, 11, 12, 13, None)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = td.survey(spark, str(tmp_path)).select(C.ID, "res100_country_code_survey")
    assert sorted(tuple(r) for r in got.collect()) == [(101, "ES"), (101, "FR"), (111, "DE"), (111, "DE")]
    joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_scores_of_a_pair_come_from_one_pass(spark):
    leaf = lambda i, v: TR.Node(i, v, 1.0)
    tree = lambda t: TR.Tree(1.0, {0: TR.Node(0, 0.0, 2.0, 0, t, 1, 2), 1: leaf(1, -0.5), 2: leaf(2, 0.5)})
    d = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "id long, a double")
    got = TR.score_many(d, {"p": [tree(0.0)], "q": [tree(2.0)]}, ["a"])
    want = TR.score(TR.score(d, [tree(0.0)], ["a"], "p"), [tree(2.0)], ["a"], "q")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1 and got.where(F.col("p") > 0.5).count() == 2
