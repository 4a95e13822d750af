"""What the fallback join moves: rows and records once, no joins; key types, clashing columns and levels that are not nested."""

import datetime as dt
import random

import pytest

from satlens.operators import joins
from satlens.plans import catalog
from satlens.plans.registry import runner

LEVELS = [["k", "m", "n"], ["k", "m"], ["k"]]


def plain(left, right, levels, keys):
    """Rows of (id, *key) -> (level, sum) by looking at all pairs."""
    out = {}
    for i, *key in left:
        at, out[i] = dict(zip(keys, key)), (None, None)
        for lv in levels:
            hits = [v for *k, v in right if all(dict(zip(keys, k))[c] == at[c] for c in lv)]
            if hits:
                out[i] = (len(lv), sum(hits))
                break
    return out


@pytest.fixture
def data():
    rng = random.Random(9)
    row = lambda: (rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), rng.choice("xyz"))
    return [(i, *row()) for i in range(120)], [(*row(), float(rng.randrange(9))) for _ in range(14)]


def test_rows_and_records_move_once(spark, data):
    l, r = spark.createDataFrame(data[0], "id int, k string, m int, n string"), spark.createDataFrame(data[1], "k string, m int, n string, v double")
    joined = joins.fallback_join(l, r, LEVELS, ["v"])
    text = joined._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in text and "Generate" not in text
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 2  # the records by all keys, then both by the key that all levels share
    assert text.count("Sort [") == 1
    assert {x["id"]: (x["match_level"], x["v"]) for x in joined.collect()} == plain(*data, LEVELS, "kmn")


def test_left_rows_keep_their_types_and_columns(spark, data):
    l = spark.createDataFrame([(i, k, m, n, -1.0) for i, k, m, n in data[0]], "id int, k string, m int, n string, v double")
    r = spark.createDataFrame([(k, m, n, v, 1) for k, m, n, v in data[1]], "k string, m long, n string, v double, w int")
    joined = joins.fallback_join(l, r, LEVELS, ["v", "w"], "level")
    assert joined.dtypes == [*l.dtypes, ("level", "int"), ("w", "bigint")]  # a clashing column is the left one
    want = plain(data[0], [(k, m, n, 1) for k, m, n, _ in data[1]], LEVELS, "kmn")
    rows = joined.collect()
    assert sorted((x["id"], x["v"], x["level"], x["w"]) for x in rows if x["level"]) == sorted((i, -1.0, *x) for i, x in want.items() if x[0])
    assert {(x["id"], x["k"], x["m"], x["n"]) for x in rows} == set(data[0]) and len(rows) == len(data[0])


def test_levels_that_are_not_nested(spark, data):
    l, r = spark.createDataFrame(data[0], "id int, k string, m int, n string"), spark.createDataFrame(data[1], "k string, m int, n string, v double")
    levels = [["k", "m", "n"], ["k", "m"], ["n"]]
    assert {x["id"]: (x["match_level"], x["v"]) for x in joins.fallback_join(l, r, levels, ["v"]).collect()} == plain(*data, levels, "kmn")


def test_the_query_counts_equal_rows_before_they_move(spark, tmp_path):
    """A flight with most of the lines: they meet as counts, and every line counts."""
    day = dt.datetime(1997, 3, 1)
    spark.createDataFrame([(1, 2), (1, 3)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")  # comes twice
    spark.createDataFrame([(k, 1, "O", day, "1") for k in range(1, 401)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 5 if k > 20 else None if k < 3 else 10, k, 1 + k % 3, 10.0, 100.0, 0.0, 0.0, "A") for k in range(1, 401)],
                          "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    catalog.load()
    found = runner("join_lf_4key")(spark, str(tmp_path))
    got = {(x["haul"], x["match_level"]): (x["n_rows"], x["lf_sum"]) for x in found.collect()}
    want = {}
    for k in range(1, 401):
        haul = ["LH", "SH", "MH"][(1 + k % 3) % 3]
        hit = k > 20  # flight 5 is MH; flight 10 and lines without a flight have no record
        n, total = want.get(at := (haul, (5 if haul == "MH" else 4) if hit else None), (0, 0.0))
        want[at] = (n + 2, total + 2 * 0.2 if hit else None)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == (pytest.approx(v[1], abs=1e-6) if v[1] is not None else None) for k, v in want.items())
    text = found._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in text and text.count("Join") == 3  # lines, orders and customers; lines and orders again
