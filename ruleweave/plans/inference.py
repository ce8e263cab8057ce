"""From comments and vectors to labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.defaults import POSITIVE_TOKEN
from ruleweave.functions.text import clean_urls, str_or_nan
from ruleweave.functions.vectors import hashed_embedding
from ruleweave.operators.centroids import (
    centroid_members,
    centroids_of,
    join_rule_centroid,
    join_text_embedding,
    keyed_comments,
    predict_side,
    rule_centroids,
)
from ruleweave.operators.stages import materialize, store_bucketed
from ruleweave.plans.ensemble import overridden


def score_comments(
    comments: DataFrame, vectors: DataFrame, centroids: DataFrame, *, metric: str = "cosine", stored: bool = False
) -> DataFrame:
    """Scoring half: (row_id, rule_key, scores, rule_violation). ``comments`` may be a stream."""
    rows = join_text_embedding(keyed_comments(comments), vectors)
    return predict_side(join_rule_centroid(rows, centroids, stored=stored), metric=metric).select(
        "row_id", "rule_key", "violating_score", "non_violating_score", "rule_violation"
    )


def centroid_classify(
    comments: DataFrame, vectors: DataFrame, *, dim: int, metric: str = "cosine", stored: bool = False
) -> DataFrame:
    """(row_id, rule_violation): one label per comment by the nearer centroid of its rule.

    ``vectors`` is (text_key, embedding), one row per text. It is used twice, for the centroids and for the comments,
    so it is computed once and stored in buckets of the key, and neither use shuffles it. Pass ``stored=True`` if it is
    such a table already (``store_bucketed``).
    """
    if not stored:
        vectors = store_bucketed(vectors, "text_key")
    centroids = rule_centroids(comments, vectors, dim=dim)
    return score_comments(comments, vectors, centroids, metric=metric).select("row_id", "rule_violation")


def centroid_classify_builtin(comments: DataFrame, *, dim: int = 64, metric: str = "cosine") -> DataFrame:
    """The same with the built-in embedder.

    Only examples go through a distinct, by rule and side, and are stored once. All vectors are computed in their rows, so
    neither they nor the comments are shuffled.
    """
    members = materialize(centroid_members(comments, with_text=True).select("rule_key", "violating", "text"))
    vectors = members.select("rule_key", "violating", hashed_embedding("text", dim).alias("embedding"))
    centroids = centroids_of(vectors, dim=dim, rules=members.select("rule_key").distinct())
    rows = comments.select(
        "row_id",
        F.when(F.col("rule").isNotNull(), clean_urls(str_or_nan("rule"))).alias("rule_key"),
        hashed_embedding(clean_urls("body"), dim).alias("embedding"),
    )
    return predict_side(join_rule_centroid(rows, centroids), metric=metric).select("row_id", "rule_violation")


def full_inference(
    comments: DataFrame,
    replies: DataFrame,
    vectors: DataFrame | None = None,
    *,
    dim: int = 64,
    metric: str = "cosine",
    positive_token: str = POSITIVE_TOKEN,
) -> DataFrame:
    """(row_id, rule_violation): centroid labels, overridden where the reply is the positive token.

    Without ``vectors`` the built-in embedder is used. A comment without a reply keeps its centroid label. The result is
    what ``write_submission`` writes.
    """
    if vectors is None:
        labels = centroid_classify_builtin(comments, dim=dim, metric=metric)
    else:
        labels = centroid_classify(comments, vectors, dim=dim, metric=metric)
    joined = labels.join(replies.select("row_id", "reply"), "row_id", "left")
    return joined.select("row_id", overridden(positive_token=positive_token).alias("rule_violation"))
