"""Joins of prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.operators.stages import pair_join


def join_predictions(
    first: DataFrame, second: DataFrame, *, on: str = "row_id", suffixes: tuple[str, str] = ("_llm", "_gte")
) -> DataFrame:
    """Inner join of two prediction tables on their key; columns they share get the suffixes.

    Missing keys match each other, and a key that occurs several times gives all combinations. A key that is frequent on
    both sides is cut into a grid of tasks.
    """
    shared = (set(first.columns) & set(second.columns)) - {on}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(on, *[F.col(c).alias(c + suffix) if c in shared else F.col(c) for c in df.columns if c != on])

    left = renamed(first, suffixes[0])
    right = renamed(second, suffixes[1]).withColumnRenamed(on, "_key")
    return pair_join(left, right, on, "_key").drop("_key")


def align_predictions(first: DataFrame, second: DataFrame, *, on: str = "row_id") -> DataFrame:
    """Pair two prediction tables row by row through their key."""
    return first.join(second, on, "inner")
