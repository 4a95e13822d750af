"""Driver contract and a DuckDB cross-check of SQL-checkable queries at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from satlens.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"
# Fast, representative oracle checks (the full set runs via tools/check_oracle.py).
SAMPLE = ["nps_by_segment", "dedup_first", "filter_years", "parse_dates", "region_map", "satisfaction",
          "corr_topk", "quantiles", "join_audit", "melt_load_factor", "explain_period", "explain_yoy",
          "flip_negate", "mae_auto", "uncertainty_curve", "split_stratified", "binary_metrics", "partition_parts",
          "scan_tolerant", "stream_increments", "sink_roundtrip", "partition_asof", "explanation_store"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"flight_month", "cabin_in_surveyed_flight", "haul", "nps"} <= set(df.columns)


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())
