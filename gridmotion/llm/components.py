"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the smallest node reached.

    Links are whole numbers without nulls; loops and repeats do no harm. Rounds go on until
    the links no longer change, each round's links being stored in the shared folder.
    """
    now = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            break
        seen = tuple(mark)
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "links")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(now.select(F.col("b"), F.col("b")).distinct())
