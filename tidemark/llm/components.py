"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("to").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("to"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("to").alias("b"))
    return moved.union(least.select("a", F.col("to").alias("b")))


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) that is not a root itself;
    the root is its component's smallest node. Stars are made until none changes;
    each round's edges are stored, so a lost executor costs one round at most."""
    edges = stored(links.where("a <> b").distinct())
    state = None
    while True:
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if not seen[0] or tuple(seen) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(seen)
        edges = stored(_small_star(_large_star(edges)).where("a <> b").distinct())
