"""MLlib fitting: promoter / detractor classifiers, imputers and encoders (§2.10
M4-M6, M19); cross-validation and search are in ``boosting`` and ``search``.

Fitting is distributed by MLlib (tree statistics are aggregated per
partition; GBT persists its own training input while it fits).  Independent
fits (labels, folds, grid points, months) run concurrently from a thread pool,
each as ordinary Spark jobs.

Trees see a feature only through its bins, so the classifiers are fitted on
``cells``: rows with equal bins and labels are one row with their weight.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from math import ceil

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators.trees import filled, with_columns

VEC = "features_vec"
DEFAULT_GBT = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "seed": 0}
WEIGHT = "_weight"
#: Fits on up to this many rows are quick as they are.
ALL_ROWS = 50_000
#: Values of a feature in the cells: MLlib's 32 bins less one for the zero that its sampling may add.
CELL_VALUES = 31
QUANTILES = 1_000
#: Cells in a task: fits run side by side, so a level of a tree needs few tasks.
TASK_CELLS = 100_000


def assemble(df: DataFrame, features: Sequence[str], out: str = VEC) -> DataFrame:
    """Tree input: NULL -> a value below every real one, then one vector column."""
    keep = [c for c in df.columns if c not in features]
    base = df.select(*keep, *filled(features))
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(base)


def gbt(label: str, params: Mapping | None = None, weight: str | None = None,
        validation: str | None = None) -> GBTClassifier:
    p = dict(DEFAULT_GBT)
    p.update(params or {})
    est = GBTClassifier(featuresCol=VEC, labelCol=label, **p)
    if weight:
        est = est.setWeightCol(weight)
    if validation:
        est = est.setValidationIndicatorCol(validation)
    return est


def bin_values(df: DataFrame, features: Sequence[str], most: int = CELL_VALUES) -> dict[str, list[float]]:
    """feature -> its values if they are at most ``most``, else ``most`` that are spread like its quantiles.

    A value that fills a bin of its own is always kept, so is the smallest (missing answers)."""
    few = df.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    few = [f for f in features if few[f] <= 2 * most]
    steps = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = df.agg(*[(F.collect_set(f) if f in few else F.percentile_approx(f, steps, 10 * QUANTILES)).alias(f) for f in features]).first()
    out = {}
    for f in features:
        at = np.sort(np.array(found[f] or [], float))
        values, n = np.unique(at, return_counts=True)
        if f in few and len(values) > most:  # their shares count, not their number
            at = np.sort(np.array(df.agg(F.percentile_approx(f, steps, 10 * QUANTILES)).first()[0], float))
            values, n = np.unique(at, return_counts=True)
        if len(values) > most:
            heavy = values[n >= len(at) / most]
            light = at[~np.isin(at, heavy)]
            rest = most - len(heavy)
            picked = light[np.linspace(0, len(light) - 1, rest).astype(int)] if rest and len(light) else []
            values = np.unique(np.concatenate([heavy, picked, at[:1]]))
        out[f] = values.tolist()
    return out


def nearest(df: DataFrame, values: Mapping[str, Sequence[float]]) -> DataFrame:
    """Each feature as the nearest of its values, the lower one half-way.

    MLlib's candidates lie half-way too, so a row is on its value's side of every one of them."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pyarrow only
    steps = [(f, np.array(v)) for f, v in values.items()]

    def compute(x: np.ndarray) -> dict[str, np.ndarray]:
        return {f: v[np.searchsorted((v[:-1] + v[1:]) / 2.0, x[:, i])] for i, (f, v) in enumerate(steps)}

    return with_columns(df, list(values), list(values), compute)


def at_most(df: DataFrame, rows: int) -> bool:
    return len(df.limit(rows + 1).select(F.lit(1)).collect()) <= rows


def merged(base: DataFrame, features: Sequence[str], labels: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Rows whose features have equal nearest values, and equal labels, as one row with the sums of ``weights``."""
    return (nearest(base, bin_values(base, features)).groupBy(*features, *labels)
            .agg(*[F.sum(w).alias(w) for w in weights]))


@contextmanager
def cells(df: DataFrame, features: Sequence[str], labels: Sequence[str], weights: Mapping[str, Column],
          all_rows: int = ALL_ROWS) -> Iterator[DataFrame]:
    """What the classifiers are fitted on: VEC, the labels and, for each of ``weights``, its sum over the rows of a cell.

    Up to ``all_rows`` rows are taken as they are.  The number of cells is bounded by the features' bins, not by the rows."""
    base = df.select(*filled(features), *labels, *[w.alias(n) for n, w in weights.items()])
    if at_most(base, all_rows):
        data = assemble(base, features).cache()
        try:
            yield data
        finally:
            data.unpersist()
        return
    data = assemble(merged(base, features, labels, list(weights)), features).cache()
    try:
        tasks = min(df.sparkSession.sparkContext.defaultParallelism, ceil(data.count() / TASK_CELLS))
        yield data.coalesce(max(1, tasks))
    finally:
        data.unpersist()


def train_pair(df: DataFrame, features: Sequence[str] = C.FEATURES, labels: Sequence[str] = C.LABELS,
               params: Mapping | None = None, weight: str | None = None) -> dict:
    """One boosted-tree classifier per label (promoter, detractor), fitted concurrently."""
    with cells(df, features, labels, {WEIGHT: F.col(weight) if weight else F.lit(1.0)}) as data:
        with ThreadPoolExecutor(max_workers=len(labels)) as ex:
            futs = {lab: ex.submit(gbt(lab, params, WEIGHT).fit, data) for lab in labels}
            return {lab: f.result() for lab, f in futs.items()}


def probability(df: DataFrame, model, out: str) -> DataFrame:
    """Positive-class probability of a fitted classifier (MLlib transform)."""
    t = model.transform(df)
    return t.withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "probability", "rawPrediction", "prediction")


def logistic(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.0):
    """Median imputation + logistic regression pipeline (linear alternative)."""
    imp_cols = [f"{f}__imp" for f in features]
    pipe = Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=imp_cols, strategy="median"),
        VectorAssembler(inputCols=imp_cols, outputCol=VEC),
        LogisticRegression(featuresCol=VEC, labelCol=label, regParam=reg)])
    data = df.select(*[F.col(f).cast("double").alias(f) for f in features], label)
    return pipe.fit(data)


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """StringIndexer (frequency order, ties alphabetical) + one-hot encoding
    that keeps an extra slot for unseen categories."""
    idx = [f"{c}_idx" for c in columns]
    vec = [f"{c}_vec" for c in columns]
    pipe = Pipeline(stages=[
        StringIndexer(inputCols=list(columns), outputCols=idx, handleInvalid="keep",
                      stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=idx, outputCols=vec, handleInvalid="keep", dropLast=True)])
    return pipe.fit(df).transform(df)
