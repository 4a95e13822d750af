"""Exact top-k inner-product search with a ball tree in every shard.

Vectors are dealt to the cell of their nearest pivot (at most ``most_pivots`` rows
of each length, picked by hash), and cells over shards of about ``shard_rows``
rows.  Each cell keeps its pivot, its radius and its largest norm.  The task of a
shard builds a ball tree and answers a block of queries by branch and bound: nodes
are visited in the order of their upper bound q.c + |q| r, and a query stops when
the next bound is below its k-th score so far.  That k-th score is shared: each
query first searches its home shard, in its own cell, and then goes only to the
cells whose bound, min(q.p + |q| r, |q| times the largest norm), reaches what it found there; all
other pairs of query and cell are dropped before any vector moves.  The 10 best
of each shard then meet in a per-query top-k.

What goes through the driver are pivots and cells, bounded by ``most_pivots`` for
each length.  Neither side is broadcast: a task holds one shard and at most about
``block_queries`` queries, and a shard is copied once for each block of the
queries that reach its cell.  A pair is dropped only where its bound proves it
useless, so the result is exact; how many are depends on the vectors.

Scores are integers (components floor(1024 x)); null vectors and vectors with a
null or non-finite component take no part; vectors of another length than the
query's are no candidates; ties go to the smaller id; rows with equal ids are
separate candidates, except the query's own id; null ids take no part; an empty
table gives an empty result.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satlens.llm.common import materialize

SCALE = 1024
LEAF_ROWS = 64


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, v): finite vectors only, components floor(1024 x) as doubles."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col(id_col).isNotNull() & v.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dim"),
                    F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x).cast("double")).alias("v")))


class BallTree:
    """Nodes as arrays: rows[start:stop] of node i, children 2i+1 and 2i+2, centre and radius."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        depth = max(0, ceil(np.log2(max(1, len(ids)) / leaf_rows))) if len(ids) > leaf_rows else 0
        n = (1 << (depth + 1)) - 1
        self.first_leaf = (1 << depth) - 1
        self.span = np.zeros((n, 2), np.int64)
        self.centre = np.zeros((n, vectors.shape[1]))
        self.radius = np.zeros(n)
        order = np.arange(len(ids))
        self.span[0] = 0, len(ids)
        for i in range(n):
            a, b = self.span[i]
            part = vectors[order[a:b]]
            if len(part):
                self.centre[i] = part.mean(axis=0)
                away = np.sqrt(((part - self.centre[i]) ** 2).sum(axis=1))
                self.radius[i] = away.max() * (1 + 1e-12) + 1e-6
            if i < self.first_leaf:
                middle = (a + b) // 2
                if len(part) > 1:  # split halfway along the line between two far points
                    one = part[away.argmax()]
                    two = part[((part - one) ** 2).sum(axis=1).argmax()]
                    order[a:b] = order[a:b][np.argsort(part @ (two - one), kind="stable")]
                self.span[2 * i + 1], self.span[2 * i + 2] = (a, middle), (middle, b)
        self.ids, self.vectors = ids[order], vectors[order]

    def search(self, query: np.ndarray, own: int, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) of at least ``least``, ties to smaller ids; the query's own id is left out."""
        length = np.sqrt((query ** 2).sum())
        best, found = np.empty(0), np.empty(0, np.int64)
        bounds = self.centre @ query + length * self.radius
        bounds += 1e-6 * np.abs(bounds) + 1e-3  # rounding must not cut off an exact tie
        order = [0]  # open nodes
        while order:
            at = max(range(len(order)), key=lambda j: bounds[order[j]])
            node = order.pop(at)
            if bounds[node] < least:
                break  # all others are lower still
            if node < self.first_leaf:
                order += [c for c in (2 * node + 1, 2 * node + 2) if bounds[c] >= least and self.span[c, 1] > self.span[c, 0]]
                continue
            a, b = self.span[node]
            score = self.vectors[a:b] @ query
            keep = (score >= least) & (self.ids[a:b] != own)
            if keep.any():
                best = np.concatenate([best, score[keep]])
                found = np.concatenate([found, self.ids[a:b][keep]])
                if len(best) > k:
                    top = np.lexsort((found, -best))[:k]
                    best, found = best[top], found[top]
                if len(best) == k:
                    least = max(least, best.min())
        return best, found


def _searched(k: int):
    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = len(shard["v"].iloc[0])
        tree = BallTree(shard["vec_id"].to_numpy(np.int64), np.vstack(shard["v"].to_list()).reshape(len(shard), width))
        out = []
        for own, v, least in zip(queries["own"], queries["query"], queries["least"]):
            scores, ids = tree.search(np.asarray(v, float), own, k, least)
            out.append((np.full(len(ids), own, np.int64), ids, scores.astype(np.int64)))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(x) for x in zip(*out)))))
    return run


def _pivots(rows: DataFrame, counts: dict[int, int], shard_rows: int, most_pivots: int) -> dict[int, np.ndarray]:
    """Different vectors of each length: one for ``shard_rows`` rows, at most ``most_pivots``."""
    wanted = {dim: min(most_pivots, ceil(n / shard_rows)) for dim, n in counts.items()}
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id")
    picked = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max(wanted.values(), default=1)).where("r <= 1 or dim > 0")
    found: dict[int, dict] = {}
    for row in picked.orderBy("dim", "r").select("dim", "v", "r").collect():
        if row["r"] <= wanted.get(row["dim"], 1):
            found.setdefault(row["dim"], {})[tuple(row["v"])] = None
    return {dim: np.array(list(vs), float).reshape(len(vs), dim) for dim, vs in found.items()}


def _assigned(pivots: dict[int, np.ndarray]):
    """Adds the cell of the nearest pivot, the distance to it and the norm."""
    def run(batches):
        for b in batches:
            for dim, part in b.groupby("dim"):
                v = np.vstack(part["v"].to_list()).reshape(len(part), dim)
                p = pivots.get(dim, np.zeros((1, dim)))
                cell = ((p ** 2).sum(axis=1) - 2 * (v @ p.T)).argmin(axis=1)
                yield part.assign(cell=cell.astype(np.int32), away=np.sqrt(((v - p[cell]) ** 2).sum(axis=1)),
                                  norm=np.sqrt((v ** 2).sum(axis=1)))
    return run


def _reaching(pivots: dict[int, np.ndarray], cells: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """(query, cell) for all cells whose bound is not below the query's ``least``."""
    def run(batches):
        for b in batches:
            for dim, part in b.groupby("width"):
                cell, radius, norm = cells[dim]
                q = np.vstack(part["query"].to_list()).reshape(len(part), dim)
                length = np.sqrt((q ** 2).sum(axis=1))[:, None]
                bound = np.minimum(q @ pivots.get(dim, np.zeros((1, dim)))[cell].T + length * radius, length * norm)
                bound += 1e-6 * (np.abs(bound) + length * norm) + 1e-3  # rounding must not cut off an exact tie
                which, to = np.nonzero(bound >= part["least"].to_numpy()[:, None])
                yield part.iloc[which].assign(cell=cell[to].astype(np.int32))
    return run


def top_k(rows: DataFrame, is_query, k: int = 10, *, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = 4096, block_queries: int = 4096, most_pivots: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row that ``is_query(id column)`` selects, against all rows."""
    finite = integer_vectors(rows, id_col, vec_col)
    counts = {r["dim"]: r["n"] for r in finite.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row a dimension
    pivots = _pivots(finite, counts, shard_rows, most_pivots)
    rows = materialize(finite.mapInPandas(_assigned(pivots), "vec_id long, dim int, v array<double>, cell int, away double, norm double"), "vectors")
    per_cell = rows.groupBy("dim", "cell").agg(F.max("away").alias("away"), F.max("norm").alias("norm"),
                                               F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    per_cell = materialize(per_cell, "cells")
    cells: dict[int, tuple] = {}
    for dim, part in per_cell.toPandas().groupby("dim"):  # at most most_pivots rows a dimension
        cells[dim] = part["cell"].to_numpy(), part["away"].to_numpy() * (1 + 1e-12) + 1e-6, part["norm"].to_numpy()
    shards = F.broadcast(per_cell.select(F.col("dim").alias("cd"), F.col("cell").alias("cc"), "shards"))
    of_cell = (F.col("dim") == F.col("cd")) & (F.col("cell") == F.col("cc"))
    dealt = F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")  # a hot cell is cut by hash
    rows = rows.join(shards, of_cell).select("vec_id", "dim", "v", "cell", dealt.alias("shard"))
    queries = (rows.where(is_query(F.col("vec_id"))).dropDuplicates(["vec_id", "dim", "v"])
               .select(F.col("vec_id").alias("own"), F.col("dim").alias("width"), F.col("v").alias("query"),
                       F.col("cell").alias("home_cell"), F.col("shard").alias("home")))

    def search(q: DataFrame) -> DataFrame:
        """q: own, width, query, least, to_cell, to_shard."""
        blocks = (q.groupBy(F.col("width").alias("bd"), F.col("to_cell").alias("bc"), F.col("to_shard").alias("bs"))
                  .agg(F.ceil(F.count("*") / block_queries).cast("int").alias("blocks")))
        blocks = materialize(blocks, "blocks")
        to = lambda d, c, s: (F.col(d) == F.col("bd")) & (F.col(c) == F.col("bc")) & (F.col(s) == F.col("bs"))
        grid = (rows.join(blocks, to("dim", "cell", "shard"))
                .select("vec_id", "dim", "v", "cell", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
        q = (q.join(blocks, to("width", "to_cell", "to_shard"))
             .select("own", "width", "query", "least", "to_cell", "to_shard",
                     F.pmod(F.xxhash64("own", F.lit("block")), F.col("blocks")).cast("int").alias("part")))
        return (grid.groupBy("dim", "cell", "shard", "block").cogroup(q.groupBy("width", "to_cell", "to_shard", "part"))
                .applyInPandas(_searched(k), "query_id long, vec_id long, score long"))

    lowest = F.lit(float("-inf"))
    home = materialize(search(queries.select("own", "width", "query", lowest.alias("least"), F.col("home_cell").alias("to_cell"),
                                             F.col("home").alias("to_shard"))), "home")
    reached = (home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
               .where(F.col("n") == k).select("query_id", F.col("kth").cast("double").alias("kth")))
    waiting = materialize(queries.join(reached, F.col("own") == F.col("query_id"), "left")
                          .select("own", "width", "query", "home_cell", "home", F.coalesce("kth", lowest).alias("least")), "waiting")
    reaching = waiting.mapInPandas(_reaching(pivots, cells), "own long, width int, query array<double>, home_cell int, home int, "
                                                             "least double, cell int")
    # worked out twice, for the number of blocks and for the search: cheaper than storing a vector for each pair
    away = (reaching.join(shards, (F.col("width") == F.col("cd")) & (F.col("cell") == F.col("cc")))
            .withColumn("to_shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
            .where("cell <> home_cell or to_shard <> home")
            .select("own", "width", "query", "least", F.col("cell").alias("to_cell"), "to_shard"))
    every = home.unionByName(search(away))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
