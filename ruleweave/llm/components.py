"""Connected components by alternating large and small stars; every round is stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.operators.stages import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link all larger neighbours of a node to the least of its neighbourhood."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (u, v) edges but the roots: the least node of its component.

    Direction, repeats and loops do not matter; edges with a null end are ignored. The rounds grow with the logarithm of the
    node count, and no round has more edges than the one before it.
    """
    tidy = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "u", "v").toDF("u", "v", "a", "b")
    tidy = tidy.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).select("u", "v")
    stars = materialize(tidy.distinct())
    before = None
    while (now := _checksum(stars)) != before:
        before = now
        large = materialize(_large_star(stars).distinct())
        small = materialize(_small_star(large).distinct())
        discard(stars)
        discard(large)
        stars = small
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
