"""Registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.llm import (
    chosen_path,
    manifest,
    maxent,
    minhash,
    mixing,
    oracle,
    packing,
    periods,
    pii,
    quality,
    repeats,
    tool_calls,
    toxicity,
    warc,
)
from ruleweave.llm.common import crc32_text, crc_fold, documents, let, text_or_empty, words
from ruleweave.operators.stages import materialize, staging_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return _QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()


def byte_bpe() -> dict:
    """Vocabulary, pre-token pattern and added tokens of the byte-level tokenizer with 50,257 ids."""
    import public_tokenizers

    return {
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
        "added": packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")),
    }


@query
def op1_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score_texts(documents(spark, folder), crc_fold("doc_id", 7) == 2)


def toxicity_model(spark: SparkSession, folder: str):
    """Fitted on labelled documents, but for those whose id has crc32 remainder 1 modulo 3."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(F.col("doc_id").alias("_id"), F.col("toxic").alias("label"))
    texts = documents(spark, folder).select(F.col("doc_id").alias("_id"), text_or_empty().alias("text"))
    return toxicity.fit_model(texts, labels.filter(crc_fold("_id", 3) != 1))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_texts(documents(spark, folder), toxicity_model(spark, folder), keep=["doc_id"])
    return scored.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


# Tools that the conversations are read as calls of.
TOOLS = {
    "ask": {
        "type": "object",
        "required": ["text", "turn"],
        "properties": {"text": {"type": "string"}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    },
    "instruct": {"type": "object", "required": ["text"], "properties": {"text": {"type": "string"}}},
}


@query
def op3_link_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """User and system turns as calls, the assistant turn after one as its result.

    Every fourth turn depends on the call two turns before it; the first turn, on the call two turns after it, which puts its
    conversation out of order.
    """
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    key = F.concat_ws("-", F.lit("call"), F.col("conv_id"), F.col("turn"))
    near = F.concat_ws("-", F.lit("call"), F.col("conv_id"), F.when(F.col("turn") == 0, 2).otherwise(F.col("turn") - 2))
    system = F.col("role") == "system"
    depends = F.when(F.col("turn") % 4 == 0, F.array(near)).otherwise(F.array().cast("array<string>"))
    calls = turns.filter(F.col("role") != "assistant").select(
        F.col("conv_id").alias("conv"),
        key.alias("call_id"),
        F.col("turn").alias("position"),
        F.when(system, "instruct").otherwise("ask").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        depends.alias("depends_on"),
    )
    asked = F.concat_ws("-", F.lit("call"), F.col("conv_id"), F.col("turn") - 1)
    results = turns.filter(F.col("role") == "assistant").select(
        F.col("conv_id").alias("conv"), asked.alias("call_id"), F.col("text").alias("content")
    )
    linked = tool_calls.link_tool_calls(calls, results, TOOLS, orphans=True)
    return linked.withColumnRenamed("conv", "conv_id")


@query
def op4_find_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(documents(spark, folder))
    listed = found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.size(f"spans.{kind.name}").cast("long").alias(f"n_{kind.name}") for kind in pii.BASE_KINDS],
        pii.span_list(pii.BASE_KINDS).alias("base_spans"),
        pii.span_list(pii.BASE_KINDS + pii.MORE_KINDS).alias("spans"),
    )
    return listed.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(quality.measure(documents(spark, folder))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


@query
def op6_minhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.fingerprint_documents(documents(spark, folder))


@query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_pack(packing.token_pieces(documents(spark, folder), **byte_bpe()))


@query
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.jaccard_classes(documents(spark, folder)).select("doc_id", "class_id", "n_links")


@query
def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    keys = mixing.document_keys()
    docs = documents(spark, folder).select(
        "doc_id", keys.source.alias("source"), keys.size.alias("size"), keys.key.alias("key")
    )
    mixed = mixing.mix_sources(materialize(docs), mixing.Keys(F.col("source"), F.col("size"), F.col("key")))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query
def op10_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, folder))


@query
def op11_warc_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages written as archives into the shared folder, and read back from them."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    path = staging_path(spark, "archives")
    warc.write_archives(warc.page_records(pages), path)
    found = warc.follow_revisits(warc.read_archives(spark, path))
    kind = pages.schema["page_id"].dataType
    return found.select(
        F.col("label").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_label").cast(kind).alias("refers_to"),
        "status",
    )


def manifest_leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered): the digests of a row as it is and, for ids divisible by 5 by crc32, with its text lowered."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    lowered = F.translate(text, oracle.UPPER, oracle.LOWER)
    changed = F.when(crc_fold("doc_id", 5) == 0, manifest.leaf_digest(*fields, lowered))
    leaf = manifest.leaf_digest(*fields, text)
    return docs.select("source", "doc_id", leaf.alias("leaf"), F.coalesce(changed, leaf).alias("tampered"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    leaves = materialize(manifest_leaves(documents(spark, folder)))
    stored = manifest.build(leaves, order=["doc_id"])
    root = F.lit(stored.root)
    proved = manifest.proofs(stored)
    folded = proved.withColumn("folded_root", manifest.fold(F.col("tampered")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        manifest.proof_digest().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in documents whose crc32 ends in 0 the words from a place on repeat with a period; both follow the crc32."""
    crc = crc32_text("doc_id")
    rest = F.floor(crc / 10)

    def repeated(ws):
        first = (rest % F.size(ws)).cast("int")
        period = (F.floor((F.size(ws) - first) / (3 + rest % 8)) + 1).cast("int")
        return F.when(F.size(ws) > 0, F.concat_ws(" ", periods.repeat_tail(ws, first, period))).otherwise("")

    text = text_or_empty()
    return docs.select("doc_id", F.when(crc % 10 == 0, let(words(text), repeated)).otherwise(text).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of each document, the longest of them, and the document without their repeats."""
    found = periods.find_runs(with_repeats(documents(spark, folder)), keep=["doc_id"], collapsed="sha256")
    longest = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("_longest", longest)
    length, period = -F.col("_longest.col1"), F.col("_longest.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_longest.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", listed).cast("binary"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
