"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import materialize


def connected(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Large and small stars in turn: each round links a node's larger, then its
    smaller, neighbours to the smallest one.  Neighbours are never gathered: a
    node's minimum is an aggregate that is joined back.  Every round is a stored
    table.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("k"))
        edges = materialize(small.select("v", "m").toDF("u", "v").unionByName(small.select("u", "m").toDF("u", "v"))
                            .where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            break
        before = now
    else:
        raise ValueError(f"components did not settle in {most_rounds} rounds")
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
