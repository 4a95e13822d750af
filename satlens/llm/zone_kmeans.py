"""Centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors are put in the order of a Hilbert curve through their box (``BITS`` bits a
component), by one range shuffle, and stored in blocks of ``BLOCK_ROWS`` rows with
the smallest and largest value of every component.  In each round a task bounds
the distance of every centroid to a block's box: a centroid whose nearest corner is
farther than the farthest corner of another cannot win any row of the block.  Rows
are compared exactly, in integers, with the centroids that are left.  A task sends
one row a cluster (count and component sums); the driver holds the centroids only.

Components become floor(scale x), clamped to +-2**27 so that every distance is exact
in a long.  Vectors that are null, of another length, or hold a null or non-finite
component take no part.  Ids may repeat or be null; each row is clustered.  With
fewer vectors than clusters there are as many clusters as vectors; without any the
result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import materialize, parts

BITS = 4
BLOCK_ROWS = 64
#: Rows of a range partition, at least one a shuffle partition.
PART_ROWS = 1 << 18
LARGEST = 1 << 27
#: Below this, products of two vectors are exact in doubles.
SMALL = 1 << 22


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, width: int, scale: int) -> DataFrame:
    """(id, v): components floor(scale x) as ints."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.lit(float(scale)) * x))).cast("int"))
    return rows.where((F.size(v) == width) & finite).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# -- order and blocks --------------------------------------------------------
def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells (rows x dimensions, each below 2**bits), as rows of big-endian bytes.

    Skilling's transform: undo the rotations bit by bit, Gray-decode, then read
    the bits of all dimensions plane by plane.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for i in range(n):
            hit = (x[i] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(hit, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[i] ^= swap if i else np.uint32(0)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip
    planes = np.concatenate([(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]).T.astype(np.uint8)
    return np.packbits(planes, axis=1)


def ranges(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every component; a task sends one row a component."""
    def run(batches):
        low, high = np.full(width, LARGEST, np.int64), np.full(width, -LARGEST, np.int64)
        for b in batches:
            v = matrix(b.column(0), width)
            if len(v):
                low, high = np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(low), pa.array(high)], names=["i", "low", "high"])

    found = (rows.select("v").mapInArrow(run, "i int, low bigint, high bigint").groupBy("i")
             .agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect())  # a row a component
    return np.array([r["low"] for r in found]), np.array([r["high"] for r in found])


def blocks(rows: DataFrame, width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored (ids, v, low, high) of blocks in Hilbert order; v: the vectors one after the other."""
    total = rows.count()
    if not total:
        return rows.sparkSession.createDataFrame([], "ids array<bigint>, v array<int>, low array<int>, high array<int>")
    low, high = ranges(rows, width)
    step = np.maximum((high - low) // (1 << BITS) + 1, 1)

    def keyed(batches):
        for b in batches:
            key = hilbert_keys((matrix(b.column(1), width) - low) // step, BITS)
            packed = pa.array([x.tobytes() for x in key], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed], names=["id", "v", "key"])

    def block(ids: list, v: np.ndarray) -> pa.RecordBatch:
        cuts = [(a, min(a + block_rows, len(ids))) for a in range(0, len(ids), block_rows)]
        lists = lambda xs, kind: pa.array(xs, pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [lists([ids[a:b] for a, b in cuts], pa.int64()), lists([v[a:b].ravel() for a, b in cuts], pa.int32()),
             lists([v[a:b].min(axis=0) for a, b in cuts], pa.int32()), lists([v[a:b].max(axis=0) for a, b in cuts], pa.int32())],
            names=["ids", "v", "low", "high"])

    def blocked(batches):
        ids, v = [], np.empty((0, width), np.int32)
        for b in batches:
            ids += b.column(0).to_pylist()
            v = np.concatenate([v, matrix(b.column(1), width)])
            whole = len(ids) // block_rows * block_rows
            if whole:
                yield block(ids[:whole], v[:whole])
                ids, v = ids[whole:], v[whole:]
        if ids:
            yield block(ids, v)

    n = max(parts(rows.sparkSession), total // PART_ROWS + 1)
    # equal vectors share a key: the salt lets a common one span several partitions
    ordered = (rows.mapInArrow(keyed, "id bigint, v array<int>, key binary").withColumn("salt", F.xxhash64("id"))
               .repartitionByRange(n, "key", "salt").sortWithinPartitions("key", "salt").select("id", "v"))
    return materialize(ordered.mapInArrow(blocked, "ids array<bigint>, v array<int>, low array<int>, high array<int>"), "zones")


# -- rounds ------------------------------------------------------------------
def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that may be nearest to some point of the box, in ascending order."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    across = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((outside ** 2).sum(axis=1) <= (across ** 2).sum(axis=1).min())


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each vector, exactly; the first of equals."""
    if max(np.abs(v).max(), np.abs(centroids).max()) < SMALL:
        x, c = v.astype(np.float64), centroids.astype(np.float64)
        d = ((x ** 2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c ** 2).sum(axis=1)).astype(np.int64)
    else:
        d = np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(v)), at]


def assigned(batches, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(ids, vectors, cluster, distance, candidates) of every block; ids only if the batches have them."""
    k, width = centroids.shape
    for b in batches:
        column = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        low, high = matrix(column["low"], width).astype(np.int64), matrix(column["high"], width).astype(np.int64)
        for i in range(b.num_rows):
            v = column["v"][i].values.to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
            near = candidates(low[i], high[i], centroids)
            at, distance = nearest(v, centroids[near])
            yield column["ids"][i].values if "ids" in column else None, v, near[at], distance, len(near)


@dataclass
class Round:
    """Sums of one assignment over all vectors."""

    size: np.ndarray
    total: np.ndarray  # k x width
    inertia: np.ndarray
    compared: int  # pairs of block and centroid
    pairs: int

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """Means rounded down; empty clusters keep theirs."""
        return np.where(self.size[:, None] > 0, self.total // np.maximum(self.size, 1)[:, None], centroids)


def sums(zones: DataFrame, centroids: np.ndarray) -> Round:
    """One row a cluster from each task, added up by cluster and component."""
    k, width = centroids.shape

    def run(batches):
        size, total, inertia, compared, n = np.zeros(k, np.int64), np.zeros((k, width), np.int64), np.zeros(k, np.int64), 0, 0
        for _, v, at, distance, near in assigned(batches, centroids):
            size += np.bincount(at, minlength=k)
            np.add.at(total, at, v)
            np.add.at(inertia, at, distance)
            compared, n = compared + near, n + 1
        # components after the sizes, inertias and pairs, so that one narrow shape serves all
        values = np.concatenate([size, inertia, [compared, n], total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["i", "n"])

    rows = zones.select("v", "low", "high").mapInArrow(run, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    values = np.zeros(2 * k + 2 + k * width, np.int64)  # as many rows
    for r in rows:
        values[r["i"]] = r["n"]
    return Round(values[:k], values[2 * k + 2:].reshape(k, width), values[k:2 * k], int(values[2 * k]), int(values[2 * k + 1]) * k)


@dataclass
class Clusters:
    zones: DataFrame
    centroids: np.ndarray
    rounds: list[Round]

    def members(self) -> DataFrame:
        """(id, cluster, distance) of every vector."""
        centroids = self.centroids

        def run(batches):
            for ids, _, at, distance, _ in assigned(batches, centroids):
                yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

        return self.zones.select("ids", "v", "low", "high").mapInArrow(run, "id bigint, cluster int, distance bigint")

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def cluster(rows: DataFrame, *, k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, seed: int = 2,
            id_col: str = "vec_id", vec_col: str = "embedding") -> Clusters:
    """Lloyd's rounds from the k vectors with the smallest sha256 of ``seed:id``; equal hashes by their components."""
    rows = materialize(integer_vectors(rows, id_col, vec_col, width, scale), "vectors")
    start = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(start.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, width)
    zones = blocks(rows, width)
    done = []
    for _ in range(rounds if len(centroids) else 0):
        done.append(sums(zones, centroids))
        centroids = done[-1].moved(centroids)
    return Clusters(zones, centroids, done)


def cluster_report(rows: DataFrame, **settings) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    id_col = settings.get("id_col", "vec_id")
    found = cluster(rows, **settings)
    members = materialize(found.members(), "members") if len(found.centroids) else \
        rows.sparkSession.createDataFrame([], "id bigint, cluster int, distance bigint")
    inertia = {r["cluster"]: r["n"] for r in members.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # k rows
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), h) for c, h in enumerate(found.digests())]
    about = F.broadcast(rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"))
    return members.join(about, "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
