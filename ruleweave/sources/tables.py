"""The comment schema on top of the shared document tables.

documents -> comments (language is the rule, source the community), labels.toxic -> label, embeddings -> vectors.
Worked examples of a comment are labelled documents of its language; toxic ones break the rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ruleweave.functions.text import digest
from ruleweave.operators.centroids import one_vector_per_text
from ruleweave.operators.stages import lookup_join, materialize


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain_comments(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, body, rule, subreddit), straight from the scan."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("body"),
        F.col("lang").alias("rule"),
        F.col("source").alias("subreddit"),
    )


def base_comments(spark: SparkSession, folder: str) -> DataFrame:
    """``plain_comments`` with ``rule_violation``, which is null for test rows."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("toxic").cast("int").alias("rule_violation")
    )
    return plain_comments(spark, folder).join(labels, "row_id", "left")


def labelled_comments(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``base_comments``. Labels of up to ``BROADCAST_LIMIT`` bytes are broadcast, so the texts stay where they are read."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("toxic").cast("int").alias("rule_violation")
    )
    return lookup_join(plain_comments(spark, folder), labels, ["row_id"], "left", spread_by="row_id", stored=True)


def document_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(text_key, embedding), one row per distinct text: that of its smallest document id."""
    # The digest is taken in the scan, so the texts themselves are not shuffled.
    docs = table(spark, folder, "documents").select("doc_id", digest("text").alias("text_key"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return one_vector_per_text(docs.join(vectors, "doc_id"), key="doc_id")


# Ids of a block of comments: so many residues in a row, and so many times each.
BLOCK_RESIDUES = 32
BLOCK_TURNS = 16
# The columns of a block. None of them is ever missing.
BLOCK = ["_rule", "_turn", "_part"]


def full_comments(spark: SparkSession, folder: str, *, labelled: bool = False) -> DataFrame:
    """Comments with the four worked examples and, if ``labelled``, the label.

    The labelled documents of each (language, side) are numbered by id; a comment takes those at its own id modulo
    their count and the next one. Numbering ranks within ranges of 65,536 ids and adds the counts before them.
    """
    base = labelled_comments(spark, folder) if labelled else plain_comments(spark, folder)
    return with_examples(spark, folder, base).drop(*BLOCK)


def placed_comments(spark: SparkSession, folder: str) -> DataFrame:
    """The comments of ``full_comments`` with ``_place``, the row's own place in the input, dealt by the columns ``BLOCK``."""
    at = F.struct(F.col("_metadata.row_index").alias("row"), F.xxhash64("_metadata.file_path").alias("file"))
    base = table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("body"), F.col("lang").alias("rule"),
        F.col("source").alias("subreddit"), at.alias("_place"),
    )
    return with_examples(spark, folder, base)


def with_examples(spark: SparkSession, folder: str, base: DataFrame) -> DataFrame:
    """Comments with their four worked examples, and the columns ``BLOCK`` by which they are dealt.

    Texts move once to their ids and once to each block of comments that takes them. A block holds the comments of a rule whose
    ids are near each other and have near residues, so that they share examples; it has at most ``BLOCK_RESIDUES * BLOCK_TURNS``
    ids, however few examples there are.
    """
    examples = labelled_comments(spark, folder).filter(F.col("rule_violation").isNotNull() & F.col("rule").isNotNull())
    keyed = examples.select(
        "rule",
        F.col("rule_violation").alias("side"),
        F.col("row_id").alias("example_id"),
        F.shiftright("row_id", 16).alias("_range"),
    )
    side = ["rule", "side"]
    counts = materialize(keyed.groupBy(*side, "_range").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(*side).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    sizes = counts.groupBy("rule").agg(
        F.sum(F.when(F.col("side") == 1, F.col("_n"))).alias("_positives"),
        F.sum(F.when(F.col("side") == 0, F.col("_n"))).alias("_negatives"),
    )
    within = Window.partitionBy(*side, "_range").orderBy("example_id")
    numbered = (
        keyed.withColumn("_rank", F.row_number().over(within))
        .join(starts, [*side, "_range"])
        .filter("side in (0, 1)")
        .select(F.col("rule").alias("_rule"), "example_id", ((F.col("_start") + F.col("_rank") - 1) * 2 + F.col("side")).alias("_key"))
    )
    texts = examples.select(F.col("row_id").alias("example_id"), F.col("body").alias("_text"))

    # Shared most by residues of the smaller side.
    turn = F.coalesce(F.greatest(F.least("_positives", "_negatives"), F.lit(1)), F.lit(1))
    block = [
        F.coalesce("rule", F.lit("")),
        F.coalesce(F.floor(F.col("row_id") / (turn * BLOCK_TURNS)), F.lit(0)),
        F.coalesce(F.floor(F.pmod(F.col("row_id"), turn) / BLOCK_RESIDUES), F.lit(0)),
    ]
    sized = lookup_join(base, sizes, ["rule"], "left", spread_by="row_id", stored=True)
    dealt = sized.select(*base.columns, "_positives", "_negatives", *[b.alias(n) for b, n in zip(block, BLOCK)])
    # Twice the number of an example and its side are its key within the rule; none where the rule has no examples.
    keys = {
        f"{name}_example_{i}": (F.col("row_id") + (i - 1)) % F.col(n) * 2 + s
        for name, s, n in (("positive", 1, "_positives"), ("negative", 0, "_negatives"))
        for i in (1, 2)
    }
    wanted = dealt.select(*BLOCK, F.explode(F.array(*keys.values())).alias("_key")).distinct()
    found = wanted.join(numbered, ["_rule", "_key"]).join(texts.filter("_text is not null"), "example_id")
    # Each block gathers a bounded number of texts, which are dealt first: nothing is combined before the shuffle.
    found = found.select(*BLOCK, "_key", "_text").repartition(*BLOCK)
    held = found.groupBy(*BLOCK).agg(F.collect_list("_key").alias("_keys"), F.collect_list("_text").alias("_texts"))
    chosen = {n: F.get("_texts", (F.array_position("_keys", k) - 1).cast("int")) for n, k in keys.items()}
    return dealt.join(held, BLOCK, "left").withColumns(chosen).select(*base.columns, *chosen, *BLOCK)
