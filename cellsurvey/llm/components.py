"""Connected components by alternating star contraction.

Every round links the larger neighbours of a node to its smallest neighbour, then a node and its smaller neighbours to the
smallest of them, until nothing changes; trees become stars in about log(n) rounds. Rounds are written to the shared
folder, so no lineage grows and a lost executor costs a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.session import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); the root is the smallest node.

    Repeated edges, loops, NULL ends and an empty table are allowed; nodes without an edge to another are not returned.
    """
    current = durable(edges.select("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while (now := _state(current)) != before:
        before = now
        current = durable(_small_star(durable(_large_star(current))))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
