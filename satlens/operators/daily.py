"""Daily scoring by the model version of the day (section 2.10 M17, 2.1 S7, S11).

Pairs of classifiers are stored as dated versions.  A row is scored and explained by the latest
version that is not after its day: one Arrow pass carries all versions that the
days need and picks each row's, so a backfill over many days is one job, and gives
what a run a day gives.  The scored store has a folder a day; scoring a day again
replaces that folder only.

Rows before the first version, or without a day, keep NULL scores and version.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import trees as TR
from satlens.operators import treeshap as TS
from satlens.sources import models_store
from satlens.sources.files import write_partitioned

PAIR = "pair"


@dataclass
class Version:
    day: str  # the first day it scores, YYYY-MM-DD
    trees: dict[str, list[TR.Tree]]  # label -> trees


def save_pair(spark: SparkSession, root: str, day: str, models: Mapping) -> None:
    """Store fitted classifiers (label -> model) as the version of a day; it counts once all of it is written."""
    weights = {label: [float(w) for w in m.treeWeights] for label, m in models.items()}
    with models_store.ready_version(spark, root, PAIR, day) as path:
        for label, m in models.items():
            m.write().overwrite().save(f"{path}/models/{label}")
        spark.createDataFrame([(json.dumps(weights),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_versions(spark: SparkSession, root: str, first: str, last: str) -> list[Version]:
    """The versions that days ``first`` to ``last`` need, oldest first."""
    days = [d for d in models_store.ready_versions(spark, root, PAIR) if d <= last]
    days = days[max(0, sum(d <= first for d in days) - 1):]
    out = []
    for day in days:
        path = f"{root.rstrip('/')}/{PAIR}/{day}"
        weights = json.loads(spark.read.text(f"{path}/about").first()[0])
        out.append(Version(day, {label: TR.stored_trees(spark, f"{path}/models/{label}", w) for label, w in weights.items()}))
    return out


def explain_by_version(df: DataFrame, versions: Sequence[Version], suffixes: Mapping[str, str], features: Sequence[str] = C.FEATURES,
                       day_col: str = C.DATE, step: int = C.ENSEMBLE_STEP) -> DataFrame:
    """``treeshap.explain_many`` with each row's own version, and ``model_version``; suffixes: label -> suffix."""
    feats = list(features)
    names = [f"{c}{s}" for s in suffixes.values() for c in [*feats, "base_value", "out_value", "mean_proba", "uncertainty"]]
    starts = np.array([v.day for v in versions], "datetime64[D]").astype("int64")
    compiled = [[(s, TS.compile_model(v.trees[label]), TR.NodeArrays.of(v.trees[label])) for label, s in suffixes.items()] for v in versions]
    for module in (TR, TS, sys.modules[__name__]):  # executors need numpy and pyarrow only
        cloudpickle.register_pickle_by_value(module)

    def compute(x: np.ndarray) -> dict[str, np.ndarray]:
        version = np.searchsorted(starts, x[:, -1], "right") - 1
        out = {n: np.full(len(x), np.nan) for n in names} | {"__version": version.astype(float)}
        for i in np.unique(version[version >= 0]):
            own = version == i
            rows = x[own, :-1]
            for suffix, shap, arrays in compiled[i]:
                new = TS.shap_columns(rows, shap, feats, suffix) | TR.ensemble_columns(arrays.terms(rows), step, suffix)
                for n, values in new.items():
                    out[n][own] = values
        return out

    t = TR.with_columns(df.withColumn("__day", F.unix_date(F.col(day_col).cast("date")).cast("double")), [*feats, "__day"],
                        [*names, "__version"], compute)
    known, days = F.col("__version") >= 0, F.array(*[F.lit(v.day) for v in versions]).cast("array<string>")
    return t.withColumns({n: F.when(known, F.col(n)) for n in names}
                         | {"model_version": F.when(known, F.get(days, F.col("__version").cast("int")))}).drop("__day", "__version")


def score_days(df: DataFrame, root: str, store: str, first: str, last: str, columns: Sequence[str], features: Sequence[str] = C.FEATURES,
               day_col: str = C.DATE, step: int = C.ENSEMBLE_STEP) -> None:
    """Score the rows of days ``first`` to ``last`` into the store's day folders (``insert_date_ci=...``); other days stay as they are."""
    from satlens.plans.scoring import nps_columns
    versions = load_versions(df.sparkSession, root, first, last)
    rows = df.where(F.col(day_col).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    t = nps_columns(explain_by_version(rows, versions, {C.PROMOTER: "_prom", C.DETRACTOR: "_det"}, features, day_col, step), features)
    day = F.col(day_col).cast("date").alias(C.SNAPSHOT)
    out = t.select("model_version", *[c for c in columns if c not in ("model_version", C.SNAPSHOT)], day)
    # A day's rows meet in few tasks, so that a day is few files; AQE splits a day too large for one.
    write_partitioned(out.hint("rebalance", F.col(C.SNAPSHOT)), store, [C.SNAPSHOT])
