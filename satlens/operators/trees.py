"""Tree ensembles as data: read a fitted MLlib GBT model's trees as arrays and
evaluate them in one Arrow pass (section 2.10 M12, M16).

The node table is model metadata (trees x nodes, bounded by maxIter and
maxDepth), so collecting it to the driver is bounded by parameters, never by
data.  Scores, virtual ensembles and SHAP values come from ``mapInArrow`` over
node arrays: every batch walks all trees level by level, so the plan's size does
not depend on the number of trees.  Only the features go to numpy; all other
columns pass through as Arrow arrays, untouched.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Missing values go below every real value ("missing is smallest").
MISSING = -1.0e9
# Rows evaluated at once: with 1000 trees a matrix of 16 MB.
BATCH_ROWS = 2048


@dataclass
class Node:
    id: int
    prediction: float
    cover: float
    feature: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1

    @property
    def is_leaf(self) -> bool:
        return self.left < 0


@dataclass
class Tree:
    weight: float
    nodes: dict[int, Node] = field(default_factory=dict)
    root: int = 0


def filled(features: Sequence[str]) -> list[Column]:
    """NULL and NaN as the value below every real one, like ``feature_matrix``."""
    return [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), F.lit(MISSING)).alias(f) for f in features]


def read_trees(spark: SparkSession, model, path: str | None = None) -> list[Tree]:
    """Node table of a tree-ensemble model via its saved form."""
    from satlens.session import scratch_path
    path = path or scratch_path(spark, f"model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    return stored_trees(spark, path, model.treeWeights)


def stored_trees(spark: SparkSession, path: str, weights: Sequence[float]) -> list[Tree]:
    """Node table of a saved tree-ensemble model."""
    data = spark.read.parquet(os.path.join(path, "data"))
    rows = data.select("treeID", "nodeData.id", "nodeData.prediction", F.col("nodeData.impurityStats")[0].alias("weight"),
                       "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
                       "nodeData.split.leftCategoriesOrThreshold").collect()
    trees = [Tree(weight=float(w)) for w in weights]
    for r in rows:
        thr = r.leftCategoriesOrThreshold[0] if r.leftCategoriesOrThreshold else 0.0
        n = Node(r.id, float(r.prediction), float(r.weight), int(r.featureIndex), float(thr),
                 int(r.leftChild), int(r.rightChild))
        trees[r.treeID].nodes[n.id] = n
    for t in trees:
        t.root = min(t.nodes)
    return trees


@dataclass
class NodeArrays:
    """All nodes of an ensemble, one after the other; leaves point to themselves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # of a leaf, in log-odds units: 2 * weight * prediction
    depth: int

    @classmethod
    def of(cls, trees: Sequence[Tree]) -> NodeArrays:
        place = {(i, k): n for n, (i, k) in enumerate((i, k) for i, t in enumerate(trees) for k in t.nodes)}
        size = len(place)
        out = cls(np.array([place[i, t.root] for i, t in enumerate(trees)], np.int64), np.zeros(size, np.int64), np.zeros(size),
                  np.arange(size), np.arange(size), np.zeros(size), 0)
        for (i, k), n in place.items():
            node = trees[i].nodes[k]
            if node.is_leaf:
                out.value[n] = 2.0 * trees[i].weight * node.prediction
            else:
                out.feature[n], out.threshold[n] = node.feature, node.threshold
                out.left[n], out.right[n] = place[i, node.left], place[i, node.right]
        level = np.unique(out.roots)
        while len(level := level[out.left[level] != level]):
            level = np.unique(np.concatenate([out.left[level], out.right[level]]))
            out.depth += 1
        return out

    def terms(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): what each tree adds to a row's log-odds (x <= threshold goes left)."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at]


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


def feature_matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    """NULL and NaN both become the value below every real one."""
    columns = [pc.cast(batch.column(batch.schema.get_field_index(f)), pa.float64(), safe=False) for f in features]
    x = np.column_stack([c.fill_null(MISSING).to_numpy(zero_copy_only=False) for c in columns]) if columns else \
        np.empty((batch.num_rows, 0))
    return np.where(np.isnan(x), MISSING, x)


def with_columns(df: DataFrame, features: Sequence[str], names: Sequence[str], compute) -> DataFrame:
    """``df`` plus double columns ``names`` = compute(feature matrix); all other columns pass through."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pyarrow only
    names, feats = list(names), list(features)
    keep = [f.name for f in df.schema.fields if f.name not in names]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name in keep]
                          + [T.StructField(n, T.DoubleType()) for n in names])

    def run(batches):
        for b in batches:
            for at in range(0, max(b.num_rows, 1), BATCH_ROWS):
                part = b.slice(at, BATCH_ROWS)
                new = compute(feature_matrix(part, feats))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in keep] + [pa.array(new[n], pa.float64()) for n in names],
                    names=keep + names)

    return df.mapInArrow(run, schema)


def margins(df: DataFrame, models: Mapping[str, Sequence[Tree]], features: Sequence[str]) -> DataFrame:
    """Log-odds of several MLlib GBT classifiers: column -> 2 * sum_t w_t * tree_t(x)."""
    arrays = {name: NodeArrays.of(trees) for name, trees in models.items()}
    return with_columns(df, features, list(models), lambda x: {n: a.terms(x).sum(axis=1) for n, a in arrays.items()})


def score(df: DataFrame, trees: Sequence[Tree], features: Sequence[str], out: str) -> DataFrame:
    """Probability of the positive class."""
    arrays = NodeArrays.of(trees)
    return with_columns(df, features, [out], lambda x: {out: sigmoid(arrays.terms(x).sum(axis=1))})


def score_many(df: DataFrame, models: Mapping[str, Sequence[Tree]], features: Sequence[str]) -> DataFrame:
    """Probabilities of several models (column -> trees) in one pass."""
    arrays = {name: NodeArrays.of(trees) for name, trees in models.items()}
    return with_columns(df, features, list(models), lambda x: {n: sigmoid(a.terms(x).sum(axis=1)) for n, a in arrays.items()})


def ensemble_columns(terms: np.ndarray, step: int, suffix: str) -> dict[str, np.ndarray]:
    """Truncated models at T/2, T/2 + step, ... < T: mean and population std of their probabilities."""
    total = terms.shape[1]
    cuts = list(range(total // 2, total, step)) or [total]
    upto = np.concatenate([np.zeros((len(terms), 1)), np.cumsum(terms, axis=1)], axis=1)
    p = sigmoid(upto[:, cuts])
    return {f"mean_proba{suffix}": p.mean(axis=1), f"uncertainty{suffix}": p.std(axis=1)}


def virtual_ensemble_many(df: DataFrame, models: Mapping[str, Sequence[Tree]], features: Sequence[str], step: int) -> DataFrame:
    """Mean probability and uncertainty of several models (suffix -> trees) in one pass."""
    arrays = {s: NodeArrays.of(t) for s, t in models.items()}
    names = [f"{c}{s}" for s in models for c in ("mean_proba", "uncertainty")]

    def compute(x):
        out = {}
        for s, a in arrays.items():
            out |= ensemble_columns(a.terms(x), step, s)
        return out

    return with_columns(df, features, names, compute)


def virtual_ensemble(df: DataFrame, trees: Sequence[Tree], features: Sequence[str], step: int, suffix: str) -> DataFrame:
    return virtual_ensemble_many(df, {suffix: trees}, features, step)
