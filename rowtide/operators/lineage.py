"""Names through time: what a name stood for at a position, and chains of renames followed to their start.

A name (of a table, a column, a key) comes to life and ends at log positions; a rename ends one
name and starts another that stands for the same thing.  ``alternating`` orders the events of each
name with ``keyed_window``, so a name with a long history is no single task; ``follow`` walks
chains of predecessors by doubling: every round a row jumps as far as all its earlier
jumps together, so a chain of n links takes log2(n) rounds, each one join over the rows that
are still under way and a written table.  Nothing recurses on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import keyed_window


def landed(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` in the shared folder and read it back."""
    from ..session import scratch_dir
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def alternating(events: DataFrame, name: Sequence[str], order: Sequence[str], bucket: Column) -> DataFrame:
    """Events with an effect, of (``side``: 1 starts, 0 ends, null uses) per ``name`` in ``order``.

    A start while the name lives, and an end or a use while it doesn't, have none (``CREATE TABLE
    IF NOT EXISTS`` of a table that exists).  Landed before and after, for a window reads its rows more
    than once.
    """
    w = keyed_window(landed(events, "names"), name, order, bucket, before=["side"])
    lives = F.coalesce(F.col("before_side"), F.lit(0)) == 1
    return landed(w.where(F.when(F.col("side") == 1, ~lives).otherwise(lives)).drop("before_side"), "names")


def follow(links: DataFrame, further: Callable[[Column, Column], Column] | None = None, name: str = "chains") -> DataFrame:
    """(id, root[, value]) of links (id, parent[, value]): the end of each row's chain of parents.

    A null parent, or one that is no id, ends a chain.  ``further(value, parent's value)`` puts the
    values along the chain together.  A parent is shared by few rows that are still under way: rows
    stop being joined once their chain's end is known.
    """
    value = ["value"] if further else []
    ids = links.select(F.col("id").alias("__p"))
    start = links.join(ids, F.col("parent") == F.col("__p"), "left").select("id", F.col("id").alias("root"), F.col("__p").alias("next"), *value)
    now = landed(start, name)
    while not now.where(F.col("next").isNotNull()).isEmpty():
        there = now.select(F.col("id").alias("next"), F.col("root").alias("__r"), F.col("next").alias("__n"), *[F.col(v).alias("__v") for v in value])
        moved = now.where(F.col("next").isNotNull()).join(there, "next").select(
            "id", F.col("__r").alias("root"), F.col("__n").alias("next"), *[further(F.col("value"), F.col("__v")).alias("value") for _ in value])
        now = landed(now.where(F.col("next").isNull()).unionByName(moved), name)
    return now.drop("next")
