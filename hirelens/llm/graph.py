"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node that it reaches.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then its
    smaller ones; rounds grow with the logarithm of the longest path. A round's links are
    written to the shared folder and read back, so a lost executor costs one round at most.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = cut(links.filter("a > b").distinct())
    seen = None
    for _ in range(ROUNDS):
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*")
        links = cut(small.filter("a > b").distinct())
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return members.unionByName(roots).distinct()
