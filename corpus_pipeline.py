"""Corpus pipeline: toxic texts go, near copies go, personal data is masked, sources are mixed, sequences are packed.

Each stage takes the table that the one before it has written, works on all of its rows, and returns the columns of
documents; the last returns the packed pieces. A stage takes its session, its documents and the folder of the side tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.llm import catalog, chosen_path, mixing, packing, pii, toxicity
from ruleweave.llm.common import checked_join, document_key, text_or_empty
from ruleweave.operators.stages import materialize


def _restored(df: DataFrame, columns: list[str], **changed) -> DataFrame:
    """The columns of a ``row`` struct, some of them replaced."""
    return df.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows whose text scores at or above the threshold go; texts without words stay."""
    model = catalog.toxicity_model(spark, folder)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    scored = toxicity.score_texts(rows, model, keep=["row"])
    return _restored(scored.filter(F.col("predicted") == 0), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each class of near copies the row with the least id stays; of equal ids, the one with the least text hash."""
    classes = chosen_path.jaccard_classes(docs, count_links=False)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = classes.groupBy("class_key").agg(F.min(order).alias("k"))
    kept = materialize(kept.select(document_key("k.doc_id").alias("_doc"), F.col("k.text_hash").alias("_hash")))
    # The row travels as a whole, so its columns may have any name.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(row, document_key("doc_id").alias("_doc"), F.xxhash64(text_or_empty()).alias("_hash"))
    left = checked_join(named, kept, ["_doc", "_hash"], "left_semi")
    if classes.groupBy("doc_id", "text_hash").count().filter("count > 1").limit(1).count():
        # Rows that repeat in full are one document.
        left = left.dropDuplicates(["_doc", "_hash"])
    return _restored(left, docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Spans are replaced by their kind; n_chars follows. Missing texts stay missing."""
    found = pii.find_spans(docs).select("row", pii.mask(F.col("text")).alias("_masked"))
    text = F.when(F.col("row.text").isNotNull(), F.col("_masked"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return _restored(found, docs.columns, **changed)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    mixed = mixing.mix_sources(docs, mixing.document_keys()).filter(F.col("copies") > 0)
    repeated = mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    return _restored(repeated, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all rows."""
    return packing.best_fit_pack(packing.token_pieces(docs, **catalog.byte_bpe()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mix", mix),
    ("pack", pack),
]

# Neither a trained model nor recursive sampling is SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = catalog.documents(spark, folder)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
