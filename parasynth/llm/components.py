"""Connected components of a graph given as edges, without collecting any of it.

Alternates two rewrites until nothing changes. *Large star*: every larger
neighbour of a node is linked to the smallest node around it. *Small star*:
every smaller neighbour is linked to the smallest one. Both keep components,
never make more edges than there were, and halve paths, so a few rounds do.
Minima are combined before the shuffle, so a node with many links is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _towards_minimum(links: DataFrame, larger_only: bool) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    if larger_only:
        least = least.select("u", F.least("u", "m").alias("m"))
        return links.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node that has an edge to another one.

    Loops, repeated edges and both directions are fine; null ends are ignored;
    no edges give no rows. Nodes are longs.
    """
    a, b = F.col(left), F.col(right)
    edges = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = checkpointed(edges)
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_minimum(both, True).distinct()
        edges = checkpointed(_towards_minimum(large, False).where("u <> v").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
