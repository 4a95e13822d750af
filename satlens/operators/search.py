"""Random search with successive halving (section 2.10 M8).

Points are drawn from a seeded generator, log-uniform where a scale is meant.
The first rung tries all of them with few rounds on a small sample of the rows;
each further rung keeps the best third and gives it more rounds and more rows.
Samples are nested: a row is in all rungs whose share exceeds the hash of its id.
The last rung uses all rows and every fold.  A rung's fits run side by side, and
one Arrow pass over the rows gives all their held-out losses after every round,
so that each trial is judged at its own best round.

A rung of more than ``models.ALL_ROWS`` rows is fitted on cells (see ``models``),
where a point keeps its meaning: the least number of rows in a leaf is a share of
the weights, which are rows, and a tree's share of the rows is drawn in parts of a
cell that are no larger than the mean cell.

Finished trials go to a table; a search that starts again with it fits only what
is missing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from math import ceil

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators.boosting import Candidate, best_round, node_trees, staged_losses
from satlens.operators.models import ALL_ROWS, TASK_CELLS, VEC, assemble, at_most, gbt, merged
from satlens.operators.trees import filled

#: parameter -> (kind, least, most)
SPACE = {"maxDepth": ("int", 2, 5), "stepSize": ("log", 0.02, 0.5), "subsamplingRate": ("even", 0.5, 1.0), "minInstancesPerNode": ("log int", 1, 50)}
#: (share of the rows, rounds); the last rung uses every fold.
RUNGS = ((1 / 27, 3), (1 / 9, 6), (1 / 3, 12), (1.0, 20))
KEEP = 3
COLUMNS = "label string, trial int, rung int, share double, rounds int, best_round int, log_loss double, " + ", ".join(
    f"{n} {'int' if 'int' in k else 'double'}" for n, (k, _, _) in SPACE.items())


def draws(n: int, seed: int, space: Mapping[str, tuple] = SPACE) -> list[dict]:
    """The points of trials 0 .. n-1; more trials begin with the same ones."""
    out = []
    for i in range(n):
        rng, point = np.random.default_rng([seed, i]), {}
        for name, (kind, low, high) in space.items():
            u = rng.random()
            value = low * (high / low) ** u if "log" in kind else low + (high + (kind == "int") - low) * u
            point[name] = min(int(value), high) if "int" in kind else float(value)
        out.append(point)
    return out


@contextmanager
def fit_input(part: DataFrame, features: Sequence[str], labels: Sequence[str], folds: Sequence[int], tasks: int,
              all_rows: int = ALL_ROWS) -> Iterator[tuple[DataFrame, dict[int, float] | None]]:
    """What a rung is fitted on: its rows with their fold and None, or, of more than ``all_rows``, parts of cells and fold -> rows shown.

    ``_w<fold>`` of a part: its rows that are shown where the fold is held out."""
    if at_most(part, all_rows):
        data = assemble(part, features).select(VEC, "fold", *labels).coalesce(tasks).cache()
        try:
            yield data, None
        finally:
            data.unpersist()
        return
    shown = {f: f"_w{f}" for f in folds}
    base = part.select(*filled(features), *labels, F.lit(1.0).alias("_rows"),
                       *[F.coalesce((F.col("fold") != f).cast("double"), F.lit(0.0)).alias(w) for f, w in shown.items()])
    data = assemble(merged(base, features, labels, ["_rows", *shown.values()]), features).cache()
    try:
        size = data.agg(F.count(F.lit(1)).alias("cells"), *[F.sum(w).alias(w) for w in ("_rows", *shown.values())]).first()
        most = ceil(size["_rows"] / size["cells"])
        parts = F.ceil(F.col("_rows") / most)
        dealt = data.withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        dealt = dealt.select(VEC, *labels, *[F.floor((F.col(w) + F.col("_part")) / F.col("_parts")).cast("double").alias(w)
                                             for w in shown.values()])  # whole rows, as many in all as the cell has
        most_parts = size["cells"] + size["_rows"] / most
        cores = part.sparkSession.sparkContext.defaultParallelism
        yield dealt.coalesce(max(1, min(cores, ceil(most_parts / TASK_CELLS)))), {f: size[w] for f, w in shown.items()}
    finally:
        data.unpersist()


def by_weight(point: Mapping, rows: float) -> dict:
    """The point for rows that stand for several: weights, not rows of the input, are counted in a leaf."""
    least = point["minInstancesPerNode"]
    if 2 * least > rows:  # no leaf can be split
        return {**point, "minInstancesPerNode": 1, "maxDepth": 0}
    return {**point, "minInstancesPerNode": 1, "minWeightFractionPerNode": (least - 0.5) / rows}


def search(df: DataFrame, features: Sequence[str] = C.FEATURES, labels: Sequence[str] = C.LABELS, *, fold_col: str = "fold", k: int = 5,
           trials: int = 50, seed: int = 0, rungs: Sequence[tuple[float, int]] = RUNGS, table: str | None = None, id_col: str = C.ID,
           threads: int = 8) -> tuple[DataFrame, dict[str, dict]]:
    """(all finished trials, label -> best point); ``table``: folder of finished trials."""
    spark = df.sparkSession
    points = draws(trials, seed)
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    rows = df.select(*features, *labels, F.col(fold_col).alias("fold"), place.alias("_place"))
    done = {(r["label"], r["trial"], r["rung"]): tuple(r) for r in finished(spark, table)}
    partitions = spark.sparkContext.defaultParallelism  # a share of the rows gets a share of the tasks
    alive = {label: list(range(trials)) for label in labels}
    for rung, (share, rounds) in enumerate(rungs):
        last = rung == len(rungs) - 1
        todo = [(label, t) for label in labels for t in alive[label] if (label, t, rung) not in done]
        folds = range(k) if last else [0]
        if todo:
            part = rows.where(F.col("_place") < share)
            tasks = max(1, ceil(partitions * share))
            with fit_input(part, features, labels, folds, tasks) as (data, shown):
                def one(job, data=data, shown=shown, rounds=rounds):
                    label, trial, fold = job
                    params = {**points[trial], "maxIter": rounds, "seed": seed}
                    if shown is None:
                        model = gbt(label, params).fit(data.where(F.col("fold") != fold))
                    else:
                        seen = data.where(F.col(f"_w{fold}") > 0)
                        model = gbt(label, by_weight(params, shown[fold]), f"_w{fold}").fit(seen)
                    return Candidate(f"{label}|{trial}|{fold}", label, fold, node_trees(model))

                with ThreadPoolExecutor(max_workers=threads) as pool:
                    fitted = list(pool.map(one, [(label, t, f) for label, t in todo for f in folds]))
            losses = staged_losses(part, fitted, features)
            new = []
            for label, t in todo:
                mean = np.mean([losses[f"{label}|{t}|{f}"] for f in folds], axis=0)  # over the folds, round by round
                best = best_round(mean)
                new.append((label, t, rung, float(share), rounds, best, float(mean[best - 1]), *points[t].values()))
            done |= {(r[0], r[1], r[2]): r for r in new}
            if table:
                spark.createDataFrame(new, COLUMNS).coalesce(1).write.mode("append").parquet(table)
        for label in labels:
            order = sorted(alive[label], key=lambda t: (done[label, t, rung][6], t))
            alive[label] = order[:1] if last else order[:-(-len(order) // KEEP)]
    best = {label: {**points[t[0]], "maxIter": done[label, t[0], len(rungs) - 1][5]} for label, t in alive.items()}
    return spark.createDataFrame([done[key] for key in sorted(done)], COLUMNS), best


def finished(spark, table: str | None) -> list:
    """Rows of the trials table, a few hundred; none before its first rung."""
    if not table:
        return []
    try:
        return spark.read.schema(COLUMNS).parquet(table).collect()
    except AnalysisException:
        return []
