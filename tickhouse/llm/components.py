"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a map-side combined minimum and a join; no neighbour list is collected. Edges are
written to the checkpoint folder after each round, and the number of rounds grows with the logarithm
of the number of nodes. Each round counts its edges: while they are few, the minima are broadcast
and the next round reads them in few tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import BROADCAST_ROWS, saved

#: Edges that one task reads at the start of a round.
TASK_EDGES = 100_000


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = F.broadcast(least) if few else least
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(F.broadcast(least) if few else least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for every node with an edge.

    ``edges`` has long columns ``a`` and ``b``; order, repeats and loops do not matter. Minima of up to
    ``broadcast`` nodes are broadcast.
    """
    current = saved(edges.where("a <> b").select("a", "b").distinct())
    before = _state(current)
    while before[0]:
        few = 2 * before[0] <= broadcast
        current = current.coalesce(1 + before[0] // TASK_EDGES)
        current = saved(_small_star(_large_star(current, few), few))
        after = _state(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return saved(stars.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")))
                 .distinct())
