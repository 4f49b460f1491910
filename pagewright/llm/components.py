"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagewright.llm.common import cut, drop_cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the node's smallest neighbour (itself included)."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return near.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    moved = down.join(least, F.col("a") == F.col("k")).select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges (a, b: long, a <> b).

    Each round is written to the shared folder; only a count and a checksum come to the driver.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "cc")
    mark = None
    for _ in range(most_rounds):
        told = Observation()
        marks = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        after = cut(_small(_large(now)).observe(told, *marks), "cc")
        drop_cut(now)
        now = after
        seen = tuple(told.get.values())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("a"), "b").distinct()
    return now.union(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
