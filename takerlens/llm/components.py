"""Connected components by alternating stars: edges are rewired to ever smaller neighbours until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of `edges` (a, b): root is the smallest node of its component.

    Each round is stored, so lineage stays short; only a count and a checksum reach the driver. A hub's edges combine to
    its smallest neighbour before the shuffle.
    """
    now = staged(_ordered(edges), "edges")
    known = _state(now)
    while True:
        now = staged(_ordered(_small_star(_large_star(now))), "edges")
        state = _state(now)
        if state == known:
            break
        known = state
    roots = now.select(F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("root").alias("node"), "root")).distinct()


def _ordered(edges: DataFrame) -> DataFrame:
    """a > b, each edge once."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    edges = edges.where("a > b")
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b")))
