"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the least of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, is hung on the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node it reaches.

    ``edges`` holds columns a and b of one orderable type; loops, repeated edges
    and nulls are ignored. Minima are taken with a map-side combine and joined
    back, which adaptive execution splits, so that a node with very many
    neighbours is no single task. Each round is written to the shared folder.
    """
    stars = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = _state(stars)
    while True:
        stars = written(_small_star(_large_star(stars).distinct()).distinct(), "stars")
        after = _state(stars)
        if after == state:
            break
        state = after
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(stars: DataFrame) -> tuple:
    """Equal for two rounds only if nothing moved: number of edges and their fingerprint."""
    row = stars.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
