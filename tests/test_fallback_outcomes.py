"""Fallback joins against plain Python, file outcomes, and step tables that follow their input."""

import gzip
import random
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from conftest import SF
from satlens.operators import joins
from satlens.plans.registry import Inputs
from satlens.sources import files as FS


def test_fallback_join(spark):
    rng = random.Random(5)
    pick = lambda values: rng.choice(values)
    row = lambda: (pick("ab"), pick(["x", "y", None]), pick([1, 2, 3, None]))
    left = [(i, *(("hot", "x", 1) if i % 3 == 0 else row())) for i in range(200)]
    right = [(*row(), pick([1.0, 2.0, None])) for _ in range(12)] + [("hot", "q", 9, 4.0), ("hot", "r", 8, 5.0)]
    levels = [["k", "m", "n"], ["k", "m"], ["k"]]
    l, r = spark.createDataFrame(left, "id int, k string, m string, n int"), spark.createDataFrame(right, "k string, m string, n int, v double")
    got = {x["id"]: (x["match_level"], x["v"]) for x in joins.fallback_join(l, r, levels, ["v"]).collect()}
    assert len(got) == 200
    for i, *key in left:
        for size in (3, 2, 1):
            hits = [v for *k, v in right if k[:size] == key[:size]]
            if hits:
                known = [v for v in hits if v is not None]
                assert got[i] == (size, sum(known) if known else None)
                break
        else:
            assert got[i] == (None, None)
    assert got[0] == (1, 9.0)
    assert joins.fallback_join(l, r.limit(0), levels, ["v"]).where("match_level IS NULL AND v IS NULL").count() == 200
    assert joins.fallback_join(l.limit(0), r, levels, ["v"]).count() == 0
    with pytest.raises(ValueError):
        joins.fallback_join(l, r, [["k"], ["m"]], ["v"])


def test_file_outcomes(spark, tmp_path):
    folder = tmp_path / "in put%20"
    folder.mkdir()
    (folder / "good.csv").write_text("1,a\n2,b\nx,c\n")
    (folder / "empty.csv").write_bytes(b"")
    (folder / "blank.csv").write_text("\n\n")
    (folder / "not_gzip.csv.gz").write_bytes(b"1,a\n2,b\n")
    (folder / "good.csv.gz").write_bytes(gzip.compress(b"3,d\n"))
    (folder / "_hidden.csv").write_text("9,z\n")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    got = {r["file"].rsplit("/", 1)[1]: (r["n_bytes"], r["status"], r["n_good"], r["n_rejected"])
           for r in FS.scan_outcomes(spark, str(folder), schema).collect()}
    assert got == {"good.csv": (12, "read", 2, 1), "empty.csv": (0, "empty", 0, 0), "blank.csv": (2, "unreadable", 0, 0),
                   "not_gzip.csv.gz": (8, "unreadable", 0, 0), "good.csv.gz": (got["good.csv.gz"][0], "read", 1, 0)}


def test_step_tables_follow_their_input(spark, tmp_path):
    for name in ("lineitem", "orders", "customer"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    first = Inputs(spark, str(tmp_path)).model_input
    assert first.inputFiles() == Inputs(spark, str(tmp_path)).model_input.inputFiles()
    lines = pq.read_table(f"{SF}/lineitem.parquet")
    pq.write_table(lines.slice(0, lines.num_rows // 2), tmp_path / "lineitem.parquet")
    second = Inputs(spark, str(tmp_path)).model_input
    assert 0 < second.count() < first.count()
