"""Monthly imputers: a stored model for each calendar month fills a missing target (section 2.10 M4).

A month's model is fitted on its rows with a known target: numeric features with
the month's exact median for a missing value, one 0/1 slot for every level of a
categorical feature, boosted regression trees over both.  Training stores each
month as a dated version; prediction loads each month's latest version as of a
date and fills all months in one Arrow pass: a row is scored by its month's trees.

Months without a known target get no model, and their rows keep NULL.  So do rows
without a month.  A level the month did not see sets no slot.  A numeric feature that
the month never knows counts as 0.  NaN is missing, in features and target.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlens.operators import stats
from satlens.operators import trees as TR
from satlens.operators.models import VEC
from satlens.sources import models_store

# The production regressor.
PARAMS = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": 42}
# Levels of all categorical features over all months; more than this raises, as each is a feature.
MAX_LEVELS = 1000


@dataclass
class About:
    """What a month's trees read, in slot order: numeric features, then levels."""

    month: int
    numeric: list[str]
    medians: list[float]
    levels: list[tuple[str, str]]  # (column, value)
    tree_weights: list[float]


@dataclass
class MonthImputer:
    about: About
    version: str
    trees: list[TR.Tree]


def number(column: str) -> Column:
    """As a double, NaN as NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def is_level(column: str, value: str) -> Column:
    return F.coalesce((F.col(column).cast("string") == value).cast("double"), F.lit(0.0))


def month_medians(known: DataFrame, numeric: Sequence[str], month_col: str) -> dict[str, dict[int, float]]:
    """feature -> month -> exact median; one bounded-window query a feature, at most 12 rows each."""
    def one(feature):
        values = known.select(month_col, number(feature).alias("__v")).where(F.col("__v").isNotNull())
        return {r[0]: float(r[1]) for r in stats.exact_quantiles(values, "__v", [0.5], [month_col]).select(month_col, "q_50").collect()}

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(numeric, pool.map(one, numeric)))


def month_levels(known: DataFrame, categorical: Sequence[str], month_col: str) -> dict[int, list[tuple[str, str]]]:
    if not categorical:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in categorical])).alias("p")
    found = (known.select(month_col, pairs).where(F.col("p.v").isNotNull()).select(month_col, "p.c", "p.v").distinct()
             .limit(12 * MAX_LEVELS + 1).collect())
    if len({(r["c"], r["v"]) for r in found}) > MAX_LEVELS or len(found) > 12 * MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} levels in {list(categorical)}: encode these columns before imputing")
    out: dict[int, list[tuple[str, str]]] = {}
    for m, c, v in sorted(map(tuple, found)):
        out.setdefault(m, []).append((c, v))
    return out


def fit_months(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (), month_col: str = "month",
               params: Mapping | None = None) -> dict[int, tuple[About, object]]:
    """month -> (what its trees read, fitted regressor), for the months of ``df`` with a known target."""
    known = (df.select(F.col(month_col).cast("int").alias(month_col), number(target).alias(target), *numeric, *categorical)
             .where(F.col(target).isNotNull() & F.col(month_col).isNotNull()).cache())

    def one(month: int) -> tuple[About, object]:
        levels = by_level.get(month, [])
        fills = [medians[f].get(month, 0.0) for f in numeric]
        slots = ([F.coalesce(number(f), F.lit(v)).alias(f"__s{i}") for i, (f, v) in enumerate(zip(numeric, fills))]
                 + [is_level(c, v).alias(f"__s{len(fills) + i}") for i, (c, v) in enumerate(levels)])
        rows = known.where(F.col(month_col) == month).select(target, *slots)
        rows = VectorAssembler(inputCols=[c for c in rows.columns if c != target], outputCol=VEC).transform(rows).select(target, VEC)
        model = GBTRegressor(featuresCol=VEC, labelCol=target, **{**PARAMS, **(params or {})}).fit(rows)
        return About(month, list(numeric), fills, levels, [float(w) for w in model.treeWeights]), model

    try:
        months = sorted(r[0] for r in known.select(month_col).distinct().collect())  # calendar months
        medians, by_level = month_medians(known, numeric, month_col), month_levels(known, categorical, month_col)
        with ThreadPoolExecutor(max_workers=4) as pool:
            return dict(zip(months, pool.map(one, months)))
    finally:
        known.unpersist()


def month_folder(month: int) -> str:
    return f"month-{month:02d}"


def save_months(spark: SparkSession, root: str, version: str, fitted: Mapping[int, tuple[About, object]]) -> None:
    """Store each month as the version of a date; a month counts only once all of it is written."""
    for month, (about, model) in fitted.items():
        with models_store.ready_version(spark, root, month_folder(month), version) as path:
            model.write().overwrite().save(f"{path}/model")
            spark.createDataFrame([(json.dumps(asdict(about)),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_months(spark: SparkSession, root: str, as_of: str) -> list[MonthImputer]:
    """The latest whole version of every month whose date is not after ``as_of``; months without one are left out."""
    out = []
    for month in range(1, 13):
        ready = [v for v in models_store.ready_versions(spark, root, month_folder(month)) if v <= as_of]
        if ready:
            path = f"{root.rstrip('/')}/{month_folder(month)}/{ready[-1]}"
            about = About(**json.loads(spark.read.text(f"{path}/about").first()[0]))
            out.append(MonthImputer(about, ready[-1], TR.stored_trees(spark, f"{path}/model", about.tree_weights)))
    return out


def fill(df: DataFrame, imputers: Sequence[MonthImputer], target: str, month_col: str = "month") -> DataFrame:
    """``df`` with ``<target>_imputed`` and ``imputer_version`` (NULL where nothing was filled), in one pass for all months."""
    out_col, version_col = f"{target}_imputed", "imputer_version"
    numeric = sorted({f for i in imputers for f in i.about.numeric})
    levels = sorted({tuple(lv) for i in imputers for lv in i.about.levels})
    slots = [f"__f{k}" for k in range(len(numeric) + len(levels))]
    specs = [(i.about.month, [numeric.index(f) for f in i.about.numeric], np.array(i.about.medians, float),
              [len(numeric) + levels.index(tuple(lv)) for lv in i.about.levels], TR.NodeArrays.of(i.trees)) for i in imputers]
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def compute(x: np.ndarray) -> dict[str, np.ndarray]:
        guess = np.full(len(x), np.nan)
        for month, own_numeric, medians, own_levels, arrays in specs:
            own = x[:, -1] == month
            if own.any():
                rows = x[own]
                values = rows[:, own_numeric]
                values = np.where(values == TR.MISSING, medians, values)
                # NodeArrays holds classifier leaves, which count twice their prediction.
                guess[own] = arrays.terms(np.column_stack([values, rows[:, own_levels]])).sum(axis=1) / 2.0
        return {"__guess": guess}

    wide = df.select("*", *[number(f).alias(s) for f, s in zip(numeric, slots)],
                     *[is_level(c, v).alias(s) for (c, v), s in zip(levels, slots[len(numeric):])],
                     F.col(month_col).cast("double").alias("__month"))
    scored = TR.with_columns(wide, [*slots, "__month"], ["__guess"], compute)
    known, guess = number(target), number("__guess")
    version = F.lit(None).cast("string")
    for i in imputers:
        version = F.when(F.col("__month") == i.about.month, F.lit(i.version)).otherwise(version)
    return scored.withColumns({out_col: F.coalesce(known, guess),
                               version_col: F.when(known.isNull() & guess.isNotNull(), version)}).drop(*slots, "__month", "__guess")


def train_and_fill(df: DataFrame, root: str, version: str, target: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                   month_col: str = "month", params: Mapping | None = None) -> DataFrame:
    """Train mode: fit and store the months of ``df`` as ``version``, then fill ``df`` with these models alone."""
    fitted = fit_months(df, target, numeric, categorical, month_col, params)
    save_months(df.sparkSession, root, version, fitted)
    own = [i for i in load_months(df.sparkSession, root, version) if i.version == version and i.about.month in fitted]
    return fill(df, own, target, month_col)


def predict_and_fill(df: DataFrame, root: str, as_of: str, target: str, month_col: str = "month") -> DataFrame:
    """Predict mode: fill ``df`` with each month's latest stored version as of a date."""
    return fill(df, load_months(df.sparkSession, root, as_of), target, month_col)
