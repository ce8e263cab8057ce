"""Combining two sets of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.defaults import ENSEMBLE_WEIGHTS, POSITIVE_TOKEN
from ruleweave.functions.text import reply_to_label
from ruleweave.operators.joins import align_predictions, join_predictions


def binarize_score(score: Column | str, threshold: float = 0.5) -> Column:
    """1 if the score is strictly above the threshold, else 0; missing and NaN give 0."""
    score = F.col(score) if isinstance(score, str) else score
    return F.coalesce((score > threshold) & ~F.isnan(score.cast("double")), F.lit(False)).cast("int")


def ensemble_weighted(
    first: DataFrame, second: DataFrame, *, weights: tuple[float, float] = ENSEMBLE_WEIGHTS
) -> DataFrame:
    """(row_id, rule_violation): weighted sum of two prediction tables, cut at one half.

    The weights need not add up to 1.
    """
    joined = join_predictions(first, second, suffixes=("_llm", "_gte"))
    blended = F.col("rule_violation_llm").cast("double") * F.lit(float(weights[0])) + F.col(
        "rule_violation_gte"
    ).cast("double") * F.lit(float(weights[1]))
    return joined.select("row_id", binarize_score(blended).alias("rule_violation"))


def overridden(
    reply: Column | str = "reply", label: Column | str = "rule_violation", *, positive_token: str = POSITIVE_TOKEN
) -> Column:
    """1 where the reply is the positive token, else the label."""
    label = F.col(label) if isinstance(label, str) else label
    return F.when(reply_to_label(reply, positive_token=positive_token), 1).otherwise(label).cast("int")


def ensemble_override(
    replies: DataFrame, predictions: DataFrame, *, positive_token: str = POSITIVE_TOKEN
) -> DataFrame:
    """(row_id, rule_violation): 1 where the reply is the positive token, else the given prediction."""
    aligned = align_predictions(replies.select("row_id", "reply"), predictions.select("row_id", "rule_violation"))
    return aligned.select("row_id", overridden(positive_token=positive_token).alias("rule_violation"))
