"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.functions import text as tx
from ruleweave.functions import vectors as vec
from ruleweave.functions.draws import draw
from ruleweave.operators import centroids as ce
from ruleweave.operators import indexing as ix
from ruleweave.operators import joins as jn
from ruleweave.operators import sampling as sa
from ruleweave.operators import sets as st
from ruleweave.operators.stages import materialize, staging_path, store_bucketed
from ruleweave.plans import ensemble as en
from ruleweave.plans import inference as inf
from ruleweave.plans import models as mo
from ruleweave.plans import training as tr
from ruleweave.sources import files as fi
from ruleweave.sources.tables import (
    BLOCK,
    base_comments,
    document_vectors,
    full_comments,
    placed_comments,
    plain_comments,
    table,
)

DIM = 64
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def vector_text(vector: Column | str) -> Column:
    """A vector as text, in millionths, so that results compare exactly."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    return F.array_join(
        F.transform(vector, lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string")), ","
    )


def train_rows(spark: SparkSession, folder: str) -> DataFrame:
    return base_comments(spark, folder).filter(F.col("rule_violation").isNotNull())


def test_rows(spark: SparkSession, folder: str) -> DataFrame:
    return base_comments(spark, folder).filter(F.col("rule_violation").isNull()).drop("rule_violation")


def linked_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("row_id"), F.concat(F.lit("see "), "url", F.lit(" now")).alias("body")
    )


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """A user turn and the assistant turn after it."""
    turns = table(spark, folder, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("text").alias("completion")
    )
    return asked.join(answered, ["conv_id", "turn"])


def label_replies(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, reply): the answer token of labelled documents, no reply for the others."""
    return base_comments(spark, folder).select("row_id", tx.label_to_token("rule_violation").alias("reply"))


def label_scores(spark: SparkSession, folder: str, column: str, *, null_key: bool = False) -> DataFrame:
    """A label as a prediction table. With ``null_key`` document 0 has a missing key."""
    key = F.nullif(F.col("doc_id"), F.lit(0)) if null_key else F.col("doc_id")
    return table(spark, folder, "labels").select(key.alias("row_id"), F.col(column).cast("int").alias("rule_violation"))


def paired_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector with the next one; every fifth is scaled to zero."""
    vectors = table(spark, folder, "embeddings")
    first = vectors.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 5)).alias("a")
    )
    second = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return first.join(second, "vec_id")


def drawn_comments(spark: SparkSession, folder: str) -> DataFrame:
    return tr.with_drawn_examples(full_comments(spark, folder))


# Sources and sinks


@query
def scan_comments(spark: SparkSession, folder: str) -> DataFrame:
    """The comment table written as compressed CSV files by many tasks and read back."""
    path = staging_path(spark, "comments")
    fi.write_comments(full_comments(spark, folder, labelled=True), path, codec="gzip")
    return fi.scan_comments(spark, path, labelled=True)


@query
def normalize_missing(spark: SparkSession, folder: str) -> DataFrame:
    """The text cells of all documents, and one more row per missing-value token and near miss."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang", "source")
    tokens = F.array(*[F.lit(t) for t in (*tx.MISSING_TOKENS, "na", "NAN", "none", "0")])
    near = docs.filter(F.col("row_id") == 0).select(F.posexplode(tokens).alias("at", "token"))
    more = near.select((-1 - F.col("at")).cast("long").alias("row_id"), *[F.col("token").alias(c) for c in ("text", "lang", "source")])
    return docs.union(more).select("row_id", *[tx.normalize_missing(c).alias(c) for c in ("text", "lang", "source")])


@query
def write_submission(spark: SparkSession, folder: str) -> DataFrame:
    """A submission written as CSV to the shared folder and read back."""
    path = staging_path(spark, "submission")
    fi.write_submission(train_rows(spark, folder), path)
    return fi.read_predictions(spark, path)


@query
def read_predictions_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Two prediction tables written as CSV to the shared folder and read back as a pair."""
    paths = []
    for column in ("toxic", "quality"):
        paths.append(staging_path(spark, f"predictions-{column}"))
        fi.write_submission(label_scores(spark, folder, column, null_key=True), paths[-1])
    return jn.join_predictions(*fi.read_predictions_pair(spark, *paths))


@query
def load_clean(spark: SparkSession, folder: str) -> DataFrame:
    pages = linked_text(spark, folder)
    # A missing text must stay missing.
    missing = pages.filter(F.col("row_id") % 10 == 0).select((-1 - F.col("row_id")).alias("row_id"), F.lit(None).cast("string").alias("body"))
    return fi.load_clean(pages.union(missing))


# Projections


@query
def clean_urls(spark: SparkSession, folder: str) -> DataFrame:
    return linked_text(spark, folder).select("row_id", tx.clean_urls("body").alias("body"))


@query
def build_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return drawn_comments(spark, folder).select("row_id", tx.build_prompt().alias("prompt"))


@query
def label_to_token(spark: SparkSession, folder: str) -> DataFrame:
    return label_replies(spark, folder).withColumnRenamed("reply", "token")


@query
def pick_example(spark: SparkSession, folder: str) -> DataFrame:
    return drawn_comments(spark, folder).select("row_id", "positive_example", "negative_example")


@query
def binarize_score(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", en.binarize_score(F.col("value") / 100).alias("label"))


@query
def sft_text(spark: SparkSession, folder: str) -> DataFrame:
    return exchanges(spark, folder).select("conv_id", "turn", tx.sft_text().alias("text"))


@query
def select_columns(spark: SparkSession, folder: str) -> DataFrame:
    comments = full_comments(spark, folder)
    return comments.select("rule", "subreddit", "row_id", "positive_example_1", "positive_example_2").drop(
        "positive_example_2"
    )


@query
def unpivot_examples(spark: SparkSession, folder: str) -> DataFrame:
    return tr.unpivot_examples(full_comments(spark, folder))


@query
def constant_label(spark: SparkSession, folder: str) -> DataFrame:
    slices = tr.unpivot_examples(full_comments(spark, folder))
    return slices.groupBy("rule", "rule_violation").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def strip_prompt(spark: SparkSession, folder: str) -> DataFrame:
    full = exchanges(spark, folder).withColumn("full", tx.sft_text())
    return full.select("conv_id", "turn", tx.strip_prompt("full", "prompt").alias("reply"))


@query
def reply_to_label(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    reply = F.when(F.col("quality") == 0, F.lower(tx.label_to_token("toxic"))).otherwise(tx.label_to_token("toxic"))
    return labels.select("doc_id", tx.reply_to_label(reply).alias("is_positive"))


@query
def str_or_nan(spark: SparkSession, folder: str) -> DataFrame:
    return base_comments(spark, folder).select("row_id", tx.str_or_nan("rule_violation").alias("label_text"))


@query
def l2_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return paired_vectors(spark, folder).select("vec_id", vector_text(vec.l2_normalize("a")).alias("unit"))


@query
def cosine_similarity(spark: SparkSession, folder: str) -> DataFrame:
    pairs = paired_vectors(spark, folder)
    return pairs.select("vec_id", F.round(vec.cosine_similarity("a", "b"), 6).alias("similarity"))


@query
def euclidean_distance(spark: SparkSession, folder: str) -> DataFrame:
    pairs = paired_vectors(spark, folder)
    return pairs.select("vec_id", F.round(vec.euclidean_distance("a", "b"), 6).alias("distance"))


def _scored(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    comments, vectors = full_comments(spark, folder), store_bucketed(document_vectors(spark, folder), "text_key")
    centroids = ce.rule_centroids(comments, vectors, dim=DIM)
    return inf.score_comments(comments, vectors, centroids, metric=metric).select(
        "row_id",
        F.round("violating_score", 6).alias("violating_score"),
        F.round("non_violating_score", 6).alias("non_violating_score"),
        "rule_violation",
    )


@query
def nearest_side(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, "cosine")


@query
def nearest_side_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, "euclidean")


# Filters


@query
def filter_not_missing(spark: SparkSession, folder: str) -> DataFrame:
    return st.filter_not_missing(base_comments(spark, folder), "rule_violation").select("row_id", "rule_violation")


@query
def filter_rule(spark: SparkSession, folder: str) -> DataFrame:
    return st.filter_rule(plain_comments(spark, folder), "en").select("row_id", "body")


@query
def filter_known_text(spark: SparkSession, folder: str) -> DataFrame:
    vectors = document_vectors(spark, folder)
    return st.filter_known_text(plain_comments(spark, folder), vectors, text_col="body", keep=["row_id"])


@query
def filter_nonempty_pool(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors also come with a rule that no row has, and with one that only their own community has."""
    train, test = train_rows(spark, folder), test_rows(spark, folder)
    solo = {"rule": F.lit("solo rule"), "subreddit": F.lit("one community")}
    pool = train.unionByName(train.filter(F.col("row_id") % 11 == 0).withColumns(solo))
    absent = test.filter(F.col("row_id") % 7 == 0).withColumns({"row_id": -1 - F.col("row_id"), "rule": F.lit("no such rule")})
    alone = test.filter(F.col("row_id") % 7 == 1).withColumns({"row_id": -1 - F.col("row_id"), **solo})
    kept = ix.filter_nonempty_pool(test.unionByName(absent).unionByName(alone), pool)
    return kept.select("row_id", "positive_pool", "negative_pool")


# Joins


@query
def join_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return jn.join_predictions(*[label_scores(spark, folder, c, null_key=True) for c in ("toxic", "quality")])


def _partners(spark: SparkSession, folder: str, role: str) -> DataFrame:
    train = train_rows(spark, folder)
    index = ix.build_pool_index(train)
    positive = role == "positive"
    picks = ix.pick_partners(
        test_rows(spark, folder), index, positive=positive, negative=not positive, id_cols=["row_id"]
    )
    found = train.select(F.col("row_id").alias("pool_id"), "rule", "subreddit")
    return picks.join(found, "pool_id").select("row_id", "pool_id", "rule", "subreddit")


@query
def join_positive(spark: SparkSession, folder: str) -> DataFrame:
    return _partners(spark, folder, "positive")


@query
def join_negative(spark: SparkSession, folder: str) -> DataFrame:
    return _partners(spark, folder, "negative")


@query
def join_text_embedding(spark: SparkSession, folder: str) -> DataFrame:
    keyed = ce.keyed_comments(plain_comments(spark, folder))
    rows = ce.join_text_embedding(keyed, document_vectors(spark, folder))
    return rows.select("row_id", vector_text("embedding").alias("embedding"))


@query
def join_rule_centroid(spark: SparkSession, folder: str) -> DataFrame:
    comments = full_comments(spark, folder)
    centroids = ce.rule_centroids(comments, document_vectors(spark, folder), dim=DIM)
    rows = ce.join_rule_centroid(ce.keyed_comments(comments).select("row_id", "rule_key"), centroids)
    return rows.select(
        "row_id",
        "rule_key",
        vector_text("violating_centroid").alias("violating_centroid"),
        vector_text("non_violating_centroid").alias("non_violating_centroid"),
    )


@query
def align_predictions(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("row_id"), F.col("toxic").alias("label"))
    return jn.align_predictions(label_replies(spark, folder), labels)


# Aggregates, sets, samples


@query
def distinct_texts(spark: SparkSession, folder: str) -> DataFrame:
    return st.distinct_texts(full_comments(spark, folder))


@query
def distinct_rules(spark: SparkSession, folder: str) -> DataFrame:
    return st.distinct_rules(plain_comments(spark, folder))


@query
def side_text_sets(spark: SparkSession, folder: str) -> DataFrame:
    return st.side_texts(full_comments(spark, folder))


@query
def rule_centroids(spark: SparkSession, folder: str) -> DataFrame:
    centroids = ce.rule_centroids(full_comments(spark, folder), document_vectors(spark, folder), dim=DIM)
    return centroids.select(
        "rule_key",
        vector_text("violating_centroid").alias("violating_centroid"),
        vector_text("non_violating_centroid").alias("non_violating_centroid"),
    )


@query
def drop_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    rows = tr.unpivot_examples(placed_comments(spark, folder), keep=[*BLOCK, "_place"])
    return st.distinct_rows(rows, group=BLOCK, place=["_place", "_slot"])


@query
def stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each stage of one run that makes the training tables, counted by that run."""
    counts = st.StageCounts()
    tr.training_tables(full_comments(spark, folder, labelled=True), counts)
    return counts.frame(spark)


@query
def union_with_missing(spark: SparkSession, folder: str) -> DataFrame:
    train = train_rows(spark, folder).select("row_id", "body", "rule_violation")
    return st.union_with_missing(train, test_rows(spark, folder).select("row_id", "subreddit", "body"))


@query
def union_slices(spark: SparkSession, folder: str) -> DataFrame:
    comments = full_comments(spark, folder)
    slices = []
    for side, label in (("positive", 1), ("negative", 0)):
        for i in (1, 2):
            columns = ["row_id", F.col(f"{side}_example_{i}").alias("body"), F.lit(label).alias("rule_violation")]
            # The columns of the slices are in different orders.
            slices.append(comments.select(*columns[i:], *columns[:i]))
    return st.union_slices(*slices)


@query
def sample_stratified(spark: SparkSession, folder: str) -> DataFrame:
    return sa.stratified_sample(plain_comments(spark, folder)).select("row_id", "rule")


@query
def sample_n(spark: SparkSession, folder: str) -> DataFrame:
    return sa.sample_n(plain_comments(spark, folder), 100).select("row_id", "rule")


@query
def head_n(spark: SparkSession, folder: str) -> DataFrame:
    return sa.head_n(plain_comments(spark, folder), 100).select("row_id", "rule")


@query
def shuffle_batches(spark: SparkSession, folder: str) -> DataFrame:
    triplets = tr.triplet_rows(test_rows(spark, folder), train_rows(spark, folder))
    batches = sa.shuffle_batches(triplets.select("row_id", "draw_no"), id_cols=["row_id", "draw_no"])
    return batches.select("row_id", "draw_no", "batch_id", "batch_pos")


@query
def shuffle_epochs(spark: SparkSession, folder: str) -> DataFrame:
    """Three epochs over all triplets, each in an order of its own."""
    triplets = tr.triplet_rows(test_rows(spark, folder), train_rows(spark, folder))
    return sa.shuffle_batches(triplets.select("row_id", "draw_no"), id_cols=["row_id", "draw_no"], epochs=3)


@query
def batch_plan(spark: SparkSession, folder: str) -> DataFrame:
    return sa.batch_plan(tr.triplet_rows(test_rows(spark, folder), train_rows(spark, folder)))


# Composites


@query
def pseudo_training_set(spark: SparkSession, folder: str) -> DataFrame:
    return tr.pseudo_training_set(full_comments(spark, folder))


@query
def prompt_dataset(spark: SparkSession, folder: str) -> DataFrame:
    comments = full_comments(spark, folder, labelled=True)
    train = comments.filter(F.col("rule_violation").isNotNull())
    test = comments.filter(F.col("rule_violation").isNull()).drop("rule_violation")
    return tr.prompt_dataset(train, test)


@query
def triplet_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return tr.triplet_dataset(test_rows(spark, folder), train_rows(spark, folder))


@query
def centroid_classify(spark: SparkSession, folder: str) -> DataFrame:
    return inf.centroid_classify(full_comments(spark, folder), document_vectors(spark, folder), dim=DIM)


@query
def ensemble_weighted(spark: SparkSession, folder: str) -> DataFrame:
    return en.ensemble_weighted(label_scores(spark, folder, "toxic"), centroid_classify(spark, folder))


@query
def ensemble_override(spark: SparkSession, folder: str) -> DataFrame:
    return en.ensemble_override(label_replies(spark, folder), centroid_classify(spark, folder))


@query
def full_inference(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, embed, classify and override, with the built-in embedder."""
    return inf.full_inference(full_comments(spark, folder), label_replies(spark, folder), dim=DIM)


@query
def score_batches(spark: SparkSession, folder: str) -> DataFrame:
    # Defined in here, so that workers get it by value and need not import this package.
    def load_letter_share():
        """A small stand-in for a model: share of the letter e in a text."""
        return lambda texts: [round(t.count("e") / len(t), 6) if t else 0.0 for t in texts]

    rows = plain_comments(spark, folder).select("row_id", "body")
    return mo.score_batches(rows, load_letter_share, "double", text_col="body").select("row_id", "value")


@query
def embed_texts(spark: SparkSession, folder: str) -> DataFrame:
    vectors = mo.embed_texts(plain_comments(spark, folder), text_col="body", dim=DIM)
    return vectors.select("text_key", vector_text("embedding").alias("embedding"))


@query
def score_text_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Learnt from the prompts of labelled comments, applied to those of all; the prompts are made once."""
    comments = tr.with_drawn_examples(full_comments(spark, folder, labelled=True))
    prompts = materialize(comments.select("row_id", "rule_violation", tx.build_prompt().alias("prompt")))
    model = mo.fit_text_classifier(prompts)
    return mo.score_text_classifier(model, prompts).select("row_id", F.round("score", 6).alias("score"), "reply")


@query
def train_infer_combine(spark: SparkSession, folder: str) -> DataFrame:
    """From training rows to a submission: prompts, a fitted classifier, its replies, centroid labels, the weighted vote."""
    comments = materialize(full_comments(spark, folder, labelled=True), codec=tr.CODEC)
    train = comments.filter(F.col("rule_violation").isNotNull())
    test = comments.filter(F.col("rule_violation").isNull()).drop("rule_violation")
    prompts = tr.prompt_dataset(train, test)
    label = tx.reply_to_label("completion").cast("int").alias("rule_violation")
    model = mo.fit_text_classifier(prompts.select("prompt", label))
    asked = tr.with_drawn_examples(test).select("row_id", tx.build_prompt().alias("prompt"))
    replies = mo.score_text_classifier(model, asked)
    voted = replies.select("row_id", tx.reply_to_label("reply").cast("int").alias("rule_violation"))
    combined = en.ensemble_weighted(voted, inf.centroid_classify_builtin(test, dim=DIM))
    path = staging_path(spark, "submission")
    fi.write_submission(combined, path)
    return fi.read_predictions(spark, path)


@query
def triplet_margin_loss(spark: SparkSession, folder: str) -> DataFrame:
    triplets = tr.triplet_rows(test_rows(spark, folder), train_rows(spark, folder))
    vectors = document_vectors(spark, folder)
    losses = mo.triplet_margin_loss(
        triplets, vectors, id_cols=["row_id", "draw_no"], metrics=("cosine", "euclidean")
    )
    return losses.withColumn("mean_loss", F.round("mean_loss", 6))


@query
def keyed_draw(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", draw("check", "doc_id", "lang").alias("draw"))
