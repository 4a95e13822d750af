"""Early stopping by truncation, and cross-validation that keeps its models (section 2.10 M7, M10, M33).

A boosted ensemble cut after round r is the ensemble of r rounds.  So one fit of
all rounds and one Arrow pass over the held-out rows, which adds up the leaf
values tree by tree, give the validation loss after every round; the kept model
is the ensemble cut at the best one.  All folds, labels or trials of a step share
the pass: a row is scored by the models that held its fold out.
"""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import clean
from satlens.operators import split as SP
from satlens.operators import trees as TR
from satlens.operators.models import WEIGHT, cells, gbt
from satlens.session import scratch_path

#: Fits side by side: cells are few, so one fit alone does not fill a cluster.
THREADS = 8


@dataclass
class Candidate:
    """A fitted ensemble and what it was not shown."""

    key: str
    label: str
    fold: int  # the fold held out
    trees: list[TR.Tree]


@dataclass
class Kept:
    """An ensemble cut at its best round; losses: the held-out log-loss after every round."""

    label: str
    fold: int
    trees: list[TR.Tree]
    losses: np.ndarray

    @property
    def best_round(self) -> int:
        return len(self.trees)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, as each of its rows is read several times."""
    path = scratch_path(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def node_trees(model) -> list[TR.Tree]:
    """The trees of a fitted model, node by node from the JVM (bounded by rounds and depth)."""
    out = []
    for weight, tree in zip(model.treeWeights, model.trees):
        found, open_ = TR.Tree(weight=float(weight)), [(tree._call_java("rootNode"), 0)]
        while open_:
            node, at = open_.pop()
            kept = TR.Node(at, float(node.prediction()), float(node.impurityStats().count()))
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                kept.feature, kept.threshold, kept.left, kept.right = int(split.featureIndex()), float(split.threshold()), 2 * at + 1, 2 * at + 2
                open_ += [(node.leftChild(), kept.left), (node.rightChild(), kept.right)]
            found.nodes[at] = kept
        out.append(found)
    return out


def staged_losses(df: DataFrame, candidates: Sequence[Candidate], features: Sequence[str], fold_col: str = "fold") -> dict[str, np.ndarray]:
    """key -> mean log-loss after 1, 2, ... rounds over the rows of the candidate's fold."""
    cloudpickle.register_pickle_by_value(TR)  # executors need numpy and pyarrow only
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    models: dict[int, list] = {}
    for i, c in enumerate(candidates):
        models.setdefault(c.fold, []).append((i, c.label, TR.NodeArrays.of(c.trees)))
    labels, feats = sorted({c.label for c in candidates}), list(features)

    def run(batches):
        sums: dict[int, list] = {}
        for b in batches:
            for at in range(0, b.num_rows, TR.BATCH_ROWS):
                part = b.slice(at, TR.BATCH_ROWS)
                x = TR.feature_matrix(part, [*feats, "fold", *labels])
                for fold, judged in models.items():
                    own = x[x[:, len(feats)] == fold]
                    for i, label, arrays in judged:
                        y = own[:, len(feats) + 1 + labels.index(label)]
                        margin = np.cumsum(arrays.terms(own[:, :len(feats)]), axis=1)
                        loss = np.logaddexp(0, np.where(y[:, None] == 1, -margin, margin)).sum(axis=0)
                        total = sums.setdefault(i, [0, np.zeros(len(loss))])
                        total[0] += len(own)
                        total[1] = total[1] + loss
        rows = [(i, r, n, v) for i, (n, loss) in sums.items() for r, v in enumerate(loss.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
            (pa.int32(), pa.int32(), pa.int64(), pa.float64()))], names=["i", "round", "n", "loss"])

    held_out = df.select(*feats, F.col(fold_col).alias("fold"), *labels).where(F.col("fold").isin(list(models)))
    rows = held_out.mapInArrow(run, "i int, round int, n bigint, loss double")
    found = {c.key: np.full(len(c.trees), np.inf) for c in candidates}
    for r in rows.groupBy("i", "round").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss")).collect():  # models x rounds
        if r["n"]:
            found[candidates[r["i"]].key][r["round"]] = r["loss"] / r["n"]
    return found


def best_round(losses: np.ndarray, patience: int | None = None) -> int:
    """Rounds to keep: up to the least loss, looking no further than ``patience`` rounds beyond the least so far."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif patience and i - best >= patience:
            break
    return best + 1


def cross_validate(df: DataFrame, features: Sequence[str] = C.FEATURES, labels: Sequence[str] = C.LABELS, fold_col: str = "fold", k: int = 5,
                   params: Mapping | None = None, patience: int | None = None) -> list[Kept]:
    """A kept model for each label and fold."""
    df = stored(df.select(*features, *labels, F.col(fold_col).alias("fold")), "folds")
    shown = {f"_w{f}": F.coalesce((F.col("fold") != f).cast("double"), F.lit(0.0)) for f in range(k)}
    with cells(df, features, labels, shown) as data:
        def one(job: tuple[str, int]) -> Candidate:
            label, fold = job
            model = gbt(label, params, f"_w{fold}").fit(data.where(F.col(f"_w{fold}") > 0))
            return Candidate(f"{label}-{fold}", label, fold, node_trees(model))

        with ThreadPoolExecutor(max_workers=THREADS) as pool:
            candidates = list(pool.map(one, [(label, f) for label in labels for f in range(k)]))
    losses = staged_losses(df, candidates, features)
    return [Kept(c.label, c.fold, c.trees[:best_round(losses[c.key], patience)], losses[c.key]) for c in candidates]


def held_out_scores(df: DataFrame, kept: Sequence[Kept], features: Sequence[str] = C.FEATURES, fold_col: str = "fold") -> DataFrame:
    """``df`` with p_<label>: each row's probability by the kept model that did not see it, in one pass."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    arrays = [(m.label, m.fold, TR.NodeArrays.of(m.trees)) for m in kept]

    def compute(x: np.ndarray) -> dict[str, np.ndarray]:
        out = {f"p_{label}": np.full(len(x), np.nan) for label, _, _ in arrays}
        for label, fold, a in arrays:
            own = x[:, -1] == fold
            out[f"p_{label}"][own] = TR.sigmoid(a.terms(x[own, :-1]).sum(axis=1))
        return out

    return TR.with_columns(df, [*features, fold_col], [f"p_{label}" for label in dict.fromkeys(m.label for m in kept)], compute)


def refit(df: DataFrame, kept: Sequence[Kept], features: Sequence[str] = C.FEATURES, params: Mapping | None = None) -> dict:
    """label -> a model of all rows with the median of its folds' best rounds, to be stored."""
    rounds = {label: int(np.median([m.best_round for m in kept if m.label == label])) for label in dict.fromkeys(m.label for m in kept)}
    with cells(df, features, list(rounds), {WEIGHT: F.lit(1.0)}) as data:
        with ThreadPoolExecutor(max_workers=THREADS) as pool:
            fits = pool.map(lambda item: gbt(item[0], {**(params or {}), "maxIter": item[1]}, WEIGHT).fit(data), rounds.items())
            return dict(zip(rounds, fits))


@dataclass(frozen=True)
class Windowed:
    """A training run over a window of dates: its rows with their split (and fold, for train rows), kept and final models."""
    rows: DataFrame
    kept: list[Kept]
    models: dict


def train_window(df: DataFrame, start: dt.date, end: dt.date, features: Sequence[str] = C.FEATURES, labels: Sequence[str] = C.LABELS, *,
                 k: int = 5, test: float = 0.2, params: Mapping | None = None, patience: int | None = None, seed: int = 0) -> Windowed:
    """Fits on the days in [start, end): test rows by year, ``k`` folds of the others, final models of all train rows."""
    window = clean.filter_range(df, C.DATE, start, end, closed="left").withColumn("year", F.year(C.DATE))
    split = stored(SP.split_stratified(window, ["year"], test, 0.0, seed=seed), "window")
    train = stored(SP.kfold_ids(split.where(F.col("split") == "train"), k, [labels[0]], seed=seed + 1), "window-folds")
    kept = cross_validate(train, features, labels, k=k, params=params, patience=patience)
    rows = train.unionByName(split.where(F.col("split") != "train"), allowMissingColumns=True)
    return Windowed(rows, kept, refit(train, kept, features, params))
