"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("u") != F.col("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``u``-``v`` edges but the roots.

    Alternates two kinds of star contraction, each a group and a join, until
    nothing changes; the number of rounds grows with the logarithm of the number
    of nodes.  Every round's edges are a stored table, so a lost executor repeats
    one round.
    """
    # A first small star over the unsorted edges costs no round of its own.
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, mark = stored(_distinct(ordered), "edges"), None
    for _ in range(max_rounds):
        now = stored(_distinct(_small_star(_distinct(_large_star(now)))), "edges")
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        # Stars have one edge for each node but the roots.
        if tuple(state) == mark and state[0] == state[2]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(state)
    raise RuntimeError("components did not settle")
