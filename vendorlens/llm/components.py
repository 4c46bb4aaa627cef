"""Connected components of an edge table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import freed, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node) of every node of ``edges`` (columns u, v).

    The table of a round is written to the shared folder, and that of the round before removed; rounds grow with the
    logarithm of the longest chain. The least neighbour of a node is combined before the shuffle.
    """
    now = staged(edges.where("u != v").select("u", "v").distinct(), "edges")
    mark = None
    while True:
        before, now = now, staged(_small_star(_large_star(now)), "edges")
        freed(before)
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = tuple(row)
