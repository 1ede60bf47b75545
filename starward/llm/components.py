"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starward.sources.scratch import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the component's smallest node.

    Each round hangs every node's larger neighbours on its smallest one, then does the same for
    the smaller neighbours (large and small star), which takes a number of rounds logarithmic in
    the longest path.  Edges never multiply.  A round's edges are written to the shared folder, so
    a lost executor costs one round at most, and two sums over them tell when nothing moves.
    The order of nodes is that of their signed numbers.  No edges give no rows.
    """
    current = staged(_downward(edges), "edges")
    before = _digest(current)
    while before[0]:
        current = staged(_small_star(_large_star(current)), "edges")
        after = _digest(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller; loops go."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("_m", "a"))
    return (
        both.join(lowest, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("_m"))
    moved = edges.join(lowest, "a").where(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("_m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    mix = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mix)).first())
