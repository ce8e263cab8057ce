"""Model steps: batch scoring with any scorer, a built-in embedder, a distributed classifier, the triplet loss."""

from __future__ import annotations

import math
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.defaults import EMBED_BATCH_SIZE, NEGATIVE_TOKEN, POSITIVE_TOKEN, TRIPLET_MARGIN
from ruleweave.functions.text import digest
from ruleweave.functions.vectors import (
    WORD_PATTERN,
    cosine_similarity,
    euclidean_distance,
    hashed_embedding,
    word_bucket,
)
from ruleweave.operators.stages import materialize, skew_join, store_bucketed

Scorer = Callable[[Sequence[str]], Sequence]
# Models that a worker holds at a time.
SCORERS_PER_WORKER = 1


def score_texts(
    texts: DataFrame,
    load_scorer: Callable[[], Scorer],
    value_type: T.DataType | str,
    *,
    text_col: str = "text",
    batch_size: int = EMBED_BATCH_SIZE,
    kept: int = SCORERS_PER_WORKER,
) -> DataFrame:
    """(text_key, value) per distinct text, scored in batches.

    ``load_scorer`` runs once per worker, which lives through many tasks, and returns a function from a list of texts to a
    list of values. It is called with ``batch_size`` texts at a time, and with fewer only at the end of a task. A worker
    holds ``kept`` scorers at most: before it loads another it drops the one loaded first.
    """
    kind = value_type if isinstance(value_type, str) else value_type.simpleString()
    name = uuid.uuid4().hex

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The table of modules outlives a task in every worker, whether or not it can import this package.
        loaded = sys.modules.setdefault("_ruleweave_scorers", types.ModuleType("_ruleweave_scorers")).__dict__
        held = loaded.setdefault("scorers", {})
        if name not in held:
            # Room for the new one first, so that a worker never holds more than it may.
            while len(held) >= max(1, kept):
                del held[next(iter(held))]
            held[name] = load_scorer()
        scorer = held[name]
        keys, texts = [], []

        def scored(n: int) -> pd.DataFrame:
            values = []
            for start in range(0, n, batch_size):
                values.extend(scorer(texts[start : min(start + batch_size, n)]))
            out = pd.DataFrame({"text_key": keys[:n], "value": values})
            del keys[:n], texts[:n]
            return out

        for frame in frames:
            keys += frame["text_key"].tolist()
            texts += frame["text"].tolist()
            if full := len(texts) // batch_size * batch_size:
                yield scored(full)
        if texts:
            yield scored(len(texts))

    distinct = texts.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
    keyed = distinct.select(digest("text").alias("text_key"), "text")
    return keyed.mapInPandas(score, f"text_key string, value {kind}")


def score_batches(
    df: DataFrame,
    load_scorer: Callable[[], Scorer],
    value_type: T.DataType | str,
    *,
    text_col: str = "text",
    value_col: str = "value",
    batch_size: int = EMBED_BATCH_SIZE,
) -> DataFrame:
    """Add a scorer's value to each row. Every distinct text is scored once; a missing text has no value."""
    values = score_texts(df, load_scorer, value_type, text_col=text_col, batch_size=batch_size)
    kind = values.schema["value"].dataType
    # Missing texts would all meet in one task of the join.
    missing = df.filter(F.col(text_col).isNull()).withColumn(value_col, F.lit(None).cast(kind))
    keyed = df.filter(F.col(text_col).isNotNull()).withColumn("text_key", digest(text_col))
    # Both inputs are shuffled for this join alone, so the adaptive planner can split a text with very many copies.
    joined = keyed.join(values.withColumnRenamed("value", value_col), "text_key", "left").drop("text_key")
    return joined.unionByName(missing)


def embed_texts(
    texts: DataFrame, *, text_col: str = "text", dim: int = 64, max_tokens: int | None = None
) -> DataFrame:
    """(text_key, embedding) per distinct text, with the built-in embedder."""
    distinct = texts.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
    return distinct.select(
        digest("text").alias("text_key"), hashed_embedding("text", dim, max_tokens).alias("embedding")
    )


def word_buckets(text: Column | str, num_features: int) -> Column:
    """The distinct hash buckets of a text's words, in the hash of the built-in embedder."""
    text = F.col(text) if isinstance(text, str) else text
    # A word is hashed once per text, however often it occurs.
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)))
    return F.array_distinct(F.transform(words, lambda w: word_bucket(w, num_features)))


@dataclass
class TextClassifier:
    """A linear model of words. ``coefficients`` is a stored table (bucket, idf, weight) with one row per hash bucket.

    A text has for each of its buckets the idf, brought to unit length over the text; their sum by weight is its raw score, and
    ``slope`` and ``intercept`` turn it into the log odds of label 1.
    """

    coefficients: DataFrame
    num_features: int
    slope: float
    intercept: float
    text_col: str


def _columns(table: DataFrame, *names: str) -> list[np.ndarray]:
    """Columns of a (bucket, ...) table that holds every bucket, in order of the buckets; as many numbers as the model has."""
    rows = sorted(table.select("bucket", *names).collect())
    return [np.array([r[n] for r in rows], np.float64) for n in names]


def _unit() -> Callable:
    """A function that gives (bucket, place of the text, value) for all buckets of the texts of a batch.

    Values of a text have unit length, or are zero where all idfs are. Defined in here, like those that call it, so that workers
    get it by value and need not import this package.
    """

    def unit(buckets: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = buckets.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at, row = buckets.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)
        values = idf[at]
        norms = np.sqrt(np.bincount(row, values * values, len(sizes)))[row]
        return at, row, np.divide(values, norms, out=np.zeros(len(at)), where=norms > 0)

    return unit


def _raw_score(spark: SparkSession, idfs: np.ndarray, weights: np.ndarray) -> Callable[[Column], Column]:
    """The raw score of a column of buckets, 0 where there are none. The model goes to the workers once, not to every row."""
    shared, unit = spark.sparkContext.broadcast((idfs, weights)), _unit()

    def score(buckets: pa.Array) -> pa.Array:
        idf, weight = shared.value
        at, row, values = unit(buckets, idf)
        return pa.array(np.bincount(row, values * weight[at], len(buckets)))

    return F.arrow_udf(score, T.DoubleType())


def _sums(rows: DataFrame, idfs: np.ndarray) -> DataFrame:
    """(bucket, one, zero, square): sums of the unit values by label, and of their squares, added up in the tasks first."""
    shared, unit = rows.sparkSession.sparkContext.broadcast(idfs), _unit()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        sums = np.zeros((3, len(idf)))
        for batch in batches:
            label, buckets = batch.columns
            at, row, values = unit(buckets, idf)
            one = label.to_numpy(zero_copy_only=False)[row] == 1
            for total, part in zip(sums, (values * one, values * ~one, values * values)):
                total += np.bincount(at, part, len(idf))
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(s[used]) for s in sums)], ["bucket", "one", "zero", "square"]
        )

    found = rows.select("label", "buckets").mapInArrow(add, "bucket int, one double, zero double, square double")
    return found.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("one", "zero", "square")])


def fit_text_classifier(
    labelled: DataFrame,
    *,
    text_col: str = "prompt",
    label_col: str = "rule_violation",
    num_features: int = 1 << 16,
    reg: float = 1e-5,
) -> TextClassifier:
    """Learn a 0/1 label from the words of a text: a diagonal linear discriminant, in three aggregates over all rows.

    The texts are read and hashed once. A bucket's weight is the difference of its means under both labels over its mean
    square plus ``reg``; slope and intercept follow from the means and the variance of the raw scores, and the shares of the
    labels. Rows without a text or a label are left out. With rows of one label only, every score is that label; with none
    there is no score.
    """
    label = F.col(label_col).cast("int").alias("label")
    rows = labelled.select(label, F.col(text_col).alias("_text")).filter("_text is not null and label in (0, 1)")
    rows = materialize(rows.select("label", word_buckets("_text", num_features).alias("buckets")))
    ones, zeros = (F.count(F.when(F.col("label") == k, 1)) for k in (1, 0))
    n1, n0 = rows.agg(ones, zeros).first()
    found = rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    every = labelled.sparkSession.range(num_features).select(F.col("id").cast("int").alias("bucket"))
    idf = F.log(F.lit(n1 + n0 + 1.0) / (F.coalesce(F.col("_n"), F.lit(0)) + 1))
    table = materialize(every.join(found, "bucket", "left").select("bucket", idf.alias("idf")))
    if not n1 or not n0:
        odds = float("nan") if n1 == n0 else float("inf") if n1 else float("-inf")
        nothing = table.withColumn("weight", F.lit(0.0))
        return TextClassifier(nothing, num_features, 0.0, odds, text_col)

    (idfs,) = _columns(table, "idf")
    square = F.col("square") / (n1 + n0) + F.lit(float(reg))
    weights = _sums(rows, idfs).select("bucket", ((F.col("one") / n1 - F.col("zero") / n0) / square).alias("weight"))
    table = materialize(table.join(weights, "bucket", "left").fillna(0.0, ["weight"]))
    raw = rows.select("label", _raw_score(rows.sparkSession, *_columns(table, "idf", "weight"))(F.col("buckets")).alias("raw"))
    means = {r["label"]: r for r in raw.groupBy("label").agg(F.avg("raw").alias("m"), F.var_pop("raw").alias("v")).collect()}
    m1, m0 = means[1]["m"], means[0]["m"]
    spread = max((n1 * means[1]["v"] + n0 * means[0]["v"]) / (n1 + n0), 1e-12)
    slope = (m1 - m0) / spread
    return TextClassifier(table, num_features, slope, math.log(n1 / n0) - slope * (m1 + m0) / 2, text_col)


def score_text_classifier(
    model: TextClassifier,
    df: DataFrame,
    *,
    positive_token: str = POSITIVE_TOKEN,
    negative_token: str = NEGATIVE_TOKEN,
) -> DataFrame:
    """Add ``score`` (probability of label 1) and ``reply`` (the answer token); a missing text has neither.

    Each row is scored where it lies, by a model that workers hold once.
    """
    # A column of its own, since it is named more than once below: the text is taken apart once.
    buckets = word_buckets(F.col(model.text_col), model.num_features).alias("_buckets")
    carried = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), buckets)
    raw = _raw_score(df.sparkSession, *_columns(model.coefficients, "idf", "weight"))(F.col("_buckets")).alias("_raw")
    joined = carried.select("_row", F.col("_buckets").isNotNull().alias("_known"), raw)
    odds = F.col("_raw") * F.lit(model.slope) + F.lit(model.intercept)
    # Only a missing text has no buckets.
    known = F.col("_known") & ~F.isnan(F.lit(model.intercept))
    scored = joined.select("_row", F.when(known, 1 / (1 + F.exp(-odds))).alias("score"))
    reply = F.when(F.col("score") > 0.5, positive_token).when(F.col("score").isNotNull(), negative_token)
    return scored.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], "score", reply.alias("reply"))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return 1 - cosine_similarity(a, b)


def triplet_margin_loss(
    triplets: DataFrame,
    vectors: DataFrame,
    *,
    id_cols: list[str],
    metrics: tuple[str, ...] = ("cosine",),
    margin: float = TRIPLET_MARGIN,
    stored: bool = False,
) -> DataFrame:
    """(metric, n_triplets, mean_loss), one row per metric: the number of triplets whose texts all have vectors, and their
    mean ``max(0, d(a,p) - d(a,n) + margin)``. The vectors are joined once for all metrics. Pass ``stored=True`` if they are
    a table in buckets of the key already (``store_bucketed``); it is not shuffled."""
    if not stored:
        vectors = store_bucketed(vectors, "text_key")
    distances = {"cosine": cosine_distance, "euclidean": euclidean_distance}
    roles = ("anchor", "positive", "negative")
    # Long form: the vectors are joined once for the three texts of a triplet.
    long = triplets.select(
        *id_cols,
        F.explode(F.array(*[F.struct(F.lit(r).alias("role"), digest(r).alias("text_key")) for r in roles])).alias("t"),
    ).select(*id_cols, "t.role", "t.text_key")
    found = skew_join(long, vectors.select("text_key", "embedding"), ["text_key"], "inner", spread_by=id_cols[0])
    wide = found.groupBy(*id_cols).agg(
        *[F.first(F.when(F.col("role") == r, F.col("embedding")), ignorenulls=True).alias(r) for r in roles]
    )
    complete = wide.filter(" and ".join(f"{r} is not null" for r in roles))

    def loss(metric: str) -> Column:
        distance = distances[metric]
        return F.greatest(F.lit(0.0), distance("anchor", "positive") - distance("anchor", "negative") + F.lit(margin))

    sums = complete.agg(F.count(F.lit(1)).alias("n_triplets"), *[F.avg(loss(m)).alias(m) for m in metrics])
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("mean_loss")) for m in metrics]))
    return sums.select("n_triplets", rows.alias("r")).select("r.metric", "n_triplets", "r.mean_loss")
