"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-large")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "cc-small")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component, for every node of edges (a, b), the roots included.

    Large-star and small-star steps in turn, each on a table written to the
    shared folder, until the edges no longer change; nothing but a count and a
    checksum of the edges reaches the driver.
    """
    edges = written(edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "cc-edges")
    state = None
    while True:
        edges = written(_small_star(written(_large_star(edges), "cc-edges")), "cc-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select("b", "b").distinct()))
