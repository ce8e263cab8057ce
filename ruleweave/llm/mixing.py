"""Mixing sources to target weights by weighted sampling without replacement (exponential keys).

A document gets the key -ln(u) / w, with u drawn from its id and text and w its quality. The documents of a source in
key order are a weighted sample without replacement of every length. A source whose target is e + f times its size
takes e complete epochs and then, in key order, documents worth f of its size. Only DataFrame expressions are used.

No window spans a source: keys fall into buckets, sums per (source, bucket) give the bucket that holds the cut, and only
its documents are sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.functions.draws import DRAW_BITS, draw
from ruleweave.llm.common import SPACE_CHARS, SPACE_RUN, text_or_empty
from ruleweave.operators.stages import lookup_join, materialize

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 17
# Documents of a source in one bucket of keys, about.
BUCKET_ROWS = 20_000
LEAST_QUALITY = 0.25
SYMBOLS = "#*$%&|<>{}[]\\^~_=+@0123456789"


def word_count(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_RUN, -1))).cast("long")


def quality(text: Column) -> Column:
    """Share of a text that is neither symbol nor digit, not below ``LEAST_QUALITY``; 1 for an empty text."""
    share = F.length(F.translate(text, SYMBOLS, "")) / F.greatest(F.length(text), F.lit(1))
    return F.when(text == "", 1.0).otherwise(F.greatest(share, F.lit(LEAST_QUALITY)))


@dataclass(frozen=True)
class Keys:
    """Columns a mix is made from."""

    source: Column
    size: Column
    key: Column


def document_keys(id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: int = SEED) -> Keys:
    text = text_or_empty(text_col)
    identity = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    uniform = (draw("mix", identity, F.md5(text.cast("binary")), seed=seed) + 0.5) / float(1 << DRAW_BITS)
    return Keys(F.col(source_col).cast("string"), word_count(text), -F.log(uniform) / quality(text))


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) for (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes. A target stops at
    ``max_repeats`` times its size and what is above goes to the others by weight. In order of limit per weight the
    sources that stop come first, so the common level of the rest follows from two running sums. The table has one row per
    source, and its two windows run in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * float(max_repeats)
    weighed = sizes.select("source", "source_size", weight.alias("_w"), limit.alias("_limit"))
    by_limit = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("_limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_w").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - stopped) / open_weight
    levels = weighed.withColumn("_level", level)
    reached = F.when(F.col("_level") * F.col("_w") <= F.col("_limit"), F.col("_level"))
    first = F.first(reached, ignorenulls=True).over(everything)
    return levels.select(
        "source", "source_size", F.least(F.col("_w") * first, F.col("_limit")).cast("double").alias("target")
    )


def mix_sources(
    docs: DataFrame,
    keys: Keys,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Per document (row, source, size, source_size, target, copies): ``row`` is the input row as a struct.

    ``copies`` is how often the mix takes the document: the complete epochs of its source, plus one if the fractional
    selection takes it. The document at the cut is taken if that brings the sum nearer to the target. Equal rows are
    interchangeable. A source without words, and one without a target, takes nothing; a missing source is one of its own.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), keys.source.alias("source"), keys.size.alias("size"), keys.key.alias("_key"))
    # Monotone in the key; no bucket is more than 1 / LEAST_QUALITY times as dense as the mean.
    spread = 1 - F.exp(-F.col("_key") * LEAST_QUALITY)
    narrow = materialize(rows.select("source", "size", spread.alias("_spread")))
    sizes = materialize(narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n")))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    buckets = max(1, -(-largest // BUCKET_ROWS))
    bucket = F.least(F.floor(F.col("_spread") * buckets), F.lit(buckets - 1)).cast("int")

    targets = source_targets(sizes.select("source", "source_size"), weights=weights, max_repeats=max_repeats)
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeats))).otherwise(0).cast("int")
    targets = targets.withColumn("_epochs", epochs)
    targets = targets.withColumn("_budget", F.when(F.col("_epochs") >= max_repeats, 0.0).otherwise(F.col("target") - F.col("_epochs") * F.col("source_size")))

    cells = narrow.withColumn("_bucket", bucket).groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    # The last bucket that starts below the budget holds the cut.
    joined = cells.join(targets.select(F.col("source").alias("_source"), "_budget"), F.col("source").eqNullSafe(F.col("_source")))
    cut = F.max(F.when(F.col("_before") < F.col("_budget"), F.struct("_bucket", "_before")))
    cuts = joined.groupBy("source").agg(cut.alias("_cut"))
    plan = (
        targets.alias("t")
        .join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
        .select(
            F.coalesce(F.concat(F.lit("s"), "t.source"), F.lit("n")).alias("_source_key"),
            "source_size",
            "target",
            "_epochs",
            "_budget",
            F.coalesce(F.col("_cut._bucket"), F.lit(-1)).alias("_cut_bucket"),
            F.coalesce(F.col("_cut._before"), F.lit(0)).alias("_cut_before"),
        )
    )
    keyed = rows.withColumn("_bucket", F.least(F.floor(spread * buckets), F.lit(buckets - 1)).cast("int"))
    keyed = keyed.withColumn("_source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    found = lookup_join(keyed, plan, ["_source_key"], "inner", spread_by="_key")
    at_cut = F.col("_bucket") == F.col("_cut_bucket")
    columns = ["row", "source", "size", "source_size", "target"]
    whole = found.filter(~at_cut).select(
        *columns, (F.col("_epochs") + (F.col("_bucket") < F.col("_cut_bucket")).cast("int")).alias("copies")
    )
    in_order = Window.partitionBy("_source_key").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    taken_before = F.col("_cut_before") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    chosen = taken_before + F.col("size") / 2 <= F.col("_budget")
    partly = found.filter(at_cut).select(*columns, (F.col("_epochs") + chosen.cast("int")).alias("copies"))
    return whole.unionByName(partly)
