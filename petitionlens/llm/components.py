"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of ``edges`` (columns a, b).

    Minima are map-side aggregates and edges meet them in joins that Spark can
    split, so a node with very many neighbours is no single task's work.  Each
    round is written to the shared folder; rounds grow with the logarithm of
    the longest path.  Null ends and loops are ignored.
    """
    now = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(now)
    while True:
        now = materialise(_small_star(_large_star(now)))
        after = _state(now)
        if after == state:
            break
        state = after
    root = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (
        both.join(least, F.col("a") == F.col("u"))
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    moved = edges.join(least, F.col("a") == F.col("u")).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
