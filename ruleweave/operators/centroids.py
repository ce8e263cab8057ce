"""Vectors of texts, per-rule centroids, and labels by nearest centroid."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.functions.text import clean_urls, digest, str_or_nan
from ruleweave.functions.vectors import cosine_similarity, euclidean_distance, nearest_side, zero_vector
from ruleweave.operators.sets import side_rows, side_texts
from ruleweave.operators.stages import lookup_join, skew_join


def one_vector_per_text(df: DataFrame, *, key: str) -> DataFrame:
    """(text_key, embedding): for each distinct ``text_key`` the vector of its smallest ``key``.

    Copies of a text meet in the map-side part of the aggregate, so a text that makes up a third of the rows does
    not pile up in one task.
    """
    known = df.filter(F.col("text_key").isNotNull())
    return known.groupBy("text_key").agg(F.min_by("embedding", key).alias("embedding"))


def rule_keys(comments: DataFrame) -> DataFrame:
    """(rule_key): every rule of the comments once."""
    return comments.filter(F.col("rule").isNotNull()).select(clean_urls(str_or_nan("rule")).alias("rule_key")).distinct()


def centroid_members(comments: DataFrame, *, with_text: bool = False) -> DataFrame:
    """(rule_key, violating, text_key and, if asked, text): what is averaged per rule and side.

    The rule's own text is appended to the non-violating side, so it counts twice if it is an example as well.
    """
    own = rule_keys(comments).select("rule_key", F.lit(False).alias("violating"), F.col("rule_key").alias("text"))
    if with_text:
        return side_texts(comments).unionAll(own).withColumn("text_key", digest("text"))
    # Without the text the digest is taken before the distinct, which then shuffles keys only.
    keys = ["rule_key", "violating", digest("text").alias("text_key")]
    return side_rows(comments).select(*keys).distinct().unionAll(own.select(*keys))


def rule_centroids(comments: DataFrame, vectors: DataFrame, *, dim: int) -> DataFrame:
    """(rule_key, violating_centroid, non_violating_centroid); a side without vectors is the zero vector."""
    members = centroid_members(comments).join(vectors.select("text_key", "embedding"), "text_key", "left")
    # A member without a vector yields no entries, but each rule is a member, so the members need not be read again for them.
    return centroids_of(members, dim=dim, rules=rule_keys(comments))


def centroids_of(members: DataFrame, *, dim: int, rules: DataFrame | None = None) -> DataFrame:
    """Both centroids per rule from (rule_key, violating, embedding).

    Vectors are added up whole, in the tasks first; a rule moves one partial sum per side and task. ``rules`` holds the rule
    keys of the result, by default those of the members, which are then read twice.
    """
    if rules is None:
        rules = members.select("rule_key").distinct()
    known = members.filter(F.col("embedding").isNotNull())
    vector = array_to_vector(F.transform("embedding", lambda x: x.cast("double")))
    means = known.select("rule_key", "violating", vector.alias("_v")).groupBy("rule_key", "violating").agg(
        vector_to_array(Summarizer.mean(F.col("_v"))).alias("_mean")
    )
    # Rules whose members all lack a vector stay in the result.
    rows = means.unionByName(rules, allowMissingColumns=True)

    def side(violating: bool) -> Column:
        return F.coalesce(F.first(F.when(F.col("violating") == violating, F.col("_mean")), ignorenulls=True), zero_vector(dim))

    return rows.groupBy("rule_key").agg(
        side(True).alias("violating_centroid"), side(False).alias("non_violating_centroid")
    )


def keyed_comments(comments: DataFrame) -> DataFrame:
    """(row_id, rule_key, text_key): all that scoring needs. A missing rule has no key."""
    return comments.select(
        "row_id",
        F.when(F.col("rule").isNotNull(), clean_urls(str_or_nan("rule"))).alias("rule_key"),
        digest(clean_urls(str_or_nan("body"))).alias("text_key"),
    )


def join_text_embedding(keyed: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add each row's vector; a text without one stays missing.

    Only keys and vectors are shuffled, and a text with very many copies is spread over several tasks.
    """
    return skew_join(keyed, vectors.select("text_key", "embedding"), ["text_key"], spread_by="row_id")


def join_rule_centroid(
    rows: DataFrame, centroids: DataFrame, *, spread_by: str = "row_id", stored: bool = False
) -> DataFrame:
    return lookup_join(rows, centroids, ["rule_key"], "left", spread_by=spread_by, stored=stored)


def side_scores(rows: DataFrame, *, metric: str = "cosine") -> DataFrame:
    """Add ``violating_score`` and ``non_violating_score``: similarities, or distances if euclidean."""
    score = {"cosine": cosine_similarity, "euclidean": euclidean_distance}[metric]
    return rows.withColumn("violating_score", score("embedding", "violating_centroid")).withColumn(
        "non_violating_score", score("embedding", "non_violating_centroid")
    )


def predict_side(rows: DataFrame, *, metric: str = "cosine") -> DataFrame:
    """Add ``rule_violation``: 0 for a row without a vector or without a rule."""
    # Scores of such rows are null, and a comparison with null takes the other branch.
    return side_scores(rows, metric=metric).withColumn(
        "rule_violation", nearest_side("violating_score", "non_violating_score", metric=metric)
    )
