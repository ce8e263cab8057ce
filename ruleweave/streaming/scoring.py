"""Scoring of comment streams against stored vectors and centroids.

Cleaning, keying and scoring keep no state, so the batch expressions run unchanged on a stream. Labels are made of each
micro-batch as a table of its own, so its keys can be counted and a text that fills it is not one task's work; the vectors lie in
buckets, and no micro-batch shuffles them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ruleweave.operators.stages import materialize, store_bucketed
from ruleweave.plans.inference import score_comments
from ruleweave.sources.files import TEST_SCHEMA, load_clean


def stream_comments(spark: SparkSession, path: str, *, max_files_per_trigger: int = 1000) -> DataFrame:
    """Comments from Parquet files as they arrive in a folder, with URLs cleaned in the body."""
    raw = (
        spark.readStream.schema(TEST_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    )
    return load_clean(raw)


def score_stream(
    comments: DataFrame,
    vectors: DataFrame,
    centroids: DataFrame,
    *,
    output: str,
    checkpoint: str,
    metric: str = "cosine",
    once: bool = True,
) -> StreamingQuery:
    """Label a comment stream and write Parquet. ``once`` handles what has arrived and stops.

    Each micro-batch writes ``batch=<number>`` below ``output``, over what an interrupted run of it may have left there, so a label
    is written once. The stored sides are deleted by ``release``, after the stream has ended.
    """
    vectors, centroids = store_bucketed(vectors, "text_key"), materialize(centroids)

    def label(batch: DataFrame, number: int) -> None:
        scored = score_comments(batch, vectors, centroids, metric=metric, stored=True)
        scored.select("row_id", "rule_violation").write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = comments.writeStream.foreachBatch(label).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
