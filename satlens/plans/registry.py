"""Registry of named queries: a DataFrame builder and (optionally) its DuckDB
oracle SQL, kept side by side so the two cannot drift apart unnoticed."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlens.sources import testdata as td


@dataclass
class Query:
    name: str
    build: Callable[["Inputs"], DataFrame]
    sql: str | None
    note: str = ""


QUERIES: dict[str, Query] = {}
#: (application, state of the input, time zone, step) -> the folder of the step's table.
_STEPS: dict[tuple, str] = {}
# The tables that the step tables and the fitted pair are made of.
STEP_TABLES = ("lineitem", "orders", "customer")


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Folder, and of each of its step tables the time, bytes and files: another state is another input."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = [sf_dir]
    for name in STEP_TABLES:
        p = path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(conf)
        size = fs.getContentSummary(p)
        out.append((fs.getFileStatus(p).getModificationTime(), size.getLength(), size.getFileCount()))
    return tuple(out)


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, bigint_counts(nudge_rounding(sql)) if sql else None, note)
        return fn
    return deco


class Inputs:
    """Lazily derived inputs for one (session, table folder).

    The two step outputs every downstream plan reads - the model input (ETL
    sink) and the scored table - are materialised once as Parquet tables in
    the shared checkpoint folder, like the production pipeline persists them.
    This cuts their lineage: self joins and scalar subqueries downstream scan
    a table instead of re-running joins and deduplication.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize

    def persist(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate step output to the shared folder and read it back."""
        return self._persisted(df, name)

    def _persisted(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        from satlens.session import scratch_path
        path = scratch_path(self.spark, f"tables/{name}-{uuid.uuid4().hex}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def table(self, name: str) -> DataFrame:
        return td.table(self.spark, self.sf_dir, name)

    @cached_property
    def survey(self) -> DataFrame:
        return td.survey(self.spark, self.sf_dir)

    @cached_property
    def load_factor(self) -> DataFrame:
        return td.load_factor(self.spark, self.sf_dir)

    @cached_property
    def model_input(self) -> DataFrame:
        from satlens.plans.etl import model_input

        def build() -> DataFrame:
            if not td.ids_hold_one_order(self.spark, self.sf_dir):
                return model_input(self.survey, self.load_factor)
            return model_input(td.survey(self.spark, self.sf_dir, also=["l_orderkey"]), self.load_factor, within=["l_orderkey"])
        return self._step("model_input", build)

    @cached_property
    def scored(self) -> DataFrame:
        from satlens.plans.scoring import linear_scored
        return self._step("scored", lambda: linear_scored(self.model_input))

    def _step(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, written by the first query of the application that needs it and read by all.

        Keyed by the input's state and the time zone, so a rewritten input gives a new table; a table that is gone is written again."""
        if not self.materialize:
            return build()
        key = (self.spark.sparkContext.applicationId, input_state(self.spark, self.sf_dir), self.spark.conf.get("spark.sql.session.timeZone"), name)
        if key in _STEPS:
            try:
                return self.spark.read.parquet(_STEPS[key])
            except AnalysisException:  # its folder was removed
                del _STEPS[key]
        from satlens.session import runtime_filters, scratch_path
        path = scratch_path(self.spark, f"tables/{name}-{uuid.uuid4().hex}")
        with runtime_filters(self.spark):
            build().write.parquet(path)
        _STEPS[key] = path
        return self.spark.read.parquet(path)


def r6(c) -> Column:
    """Round doubles to 6 places for comparison with the SQL oracle.

    A mean of decimal-like values often lies exactly on a 7th-decimal tie, and
    two engines summing in different orders land one ulp either side of it; a
    1e-9 nudge puts both on the same side.  ``+ 0.0`` turns -0.0 into 0.0.
    The oracle side applies the identical expression (``nudge_rounding``)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x + F.lit(1e-9), 6) + F.lit(0.0)


def bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's is BIGINT.  Cast each
    ``count_if(...)`` of an oracle text to BIGINT so both sides agree."""
    out, i, key = [], 0, "count_if("
    low = sql.lower()
    while True:
        j = low.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_counts(sql[j + len(key):k - 1])
        out.append(sql[i:j] + f"CAST(count_if({inner}) AS BIGINT)")
        i = k


def nudge_rounding(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` of an oracle SQL text into
    ``(round((<expr>) + 1e-9, 6) + 0.0)`` - the same convention as ``r6``."""
    out, i, key = [], 0, "round("
    low = sql.lower()
    while True:
        j = low.find(key, i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 1, j + len(key), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_end = k - 1
        if comma >= 0 and sql[comma + 1:inner_end].strip() == "6":
            expr = nudge_rounding(sql[j + len(key):comma])
            out.append(sql[i:j] + f"(round(({expr}) + 1e-9, 6) + 0.0)")
        else:
            out.append(sql[i:j] + "round(" + nudge_rounding(sql[j + len(key):inner_end]) + ")")
        i = k


def rounded(df: DataFrame, exclude=()) -> DataFrame:
    """Round every double column to 6 places."""
    from pyspark.sql import types as T
    return df.select(*[r6(f.name).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exclude
                       else F.col(f.name) for f in df.schema.fields])


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(Inputs(spark, sf_dir))
    run.__name__ = name
    return run
