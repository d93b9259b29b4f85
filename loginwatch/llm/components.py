"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.llm.common import split_join, stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def _large(edges: DataFrame, total: int) -> DataFrame:
    """Hangs the larger neighbours of every node on its least neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"), F.count(F.lit(1)).alias("n"))
    return split_join(both, least, "a", 2 * total).where("b > a").select(
        F.col("least").alias("a"), "b"
    ).distinct()


def _small(edges: DataFrame, total: int) -> DataFrame:
    """Hangs every node and its smaller neighbours on the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"), F.count(F.lit(1)).alias("n"))
    joined = split_join(edges, least, "b", total)
    moved = joined.where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(joined.select(F.col("least").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for each node of a link.

    ``edges``: a stored table with ``a`` < ``b``. Each round hangs neighbours on smaller
    nodes, first the larger ones, then the smaller; the rounds grow with the logarithm of
    the longest path, and end when every class is a star around its least node. Each round
    is written to the shared folder, so that a lost executor costs one round at most. No
    neighbourhood is gathered: least neighbours are aggregates with a map-side part,
    and hot nodes are joined by broadcast. No links give an empty result.
    """
    mark = _mark(edges)
    while True:
        total = mark[0]
        if not total:
            break
        wide = stored(_large(edges, total), "large_stars")
        edges = stored(_small(wide, wide.count()), "small_stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
