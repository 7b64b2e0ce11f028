"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), root the least node of its component.

    Each round links nodes to the least one they know of, and is written down; it ends
    when a round changes nothing, after a number of rounds that grows with the logarithm
    of the components' size.  Only a count and a checksum come to the driver.
    """
    now = written(edges.where("u <> v").distinct(), "edges")
    before = None
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).collect()[0]
        if state == before:
            break
        before = state
    found = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
