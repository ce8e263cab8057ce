"""Exact samples, head, and shuffled batches, without a sort or a window over a whole group.

A sample keeps the rows with the smallest keyed draws of their stratum. Counts per (stratum, high bits of the draw) tell which
bucket holds the last kept row. Rows of buckets before it are kept by a filter, without a shuffle; only the rows of that
bucket are ranked. Ranks count rows, so null and repeated ids neither lose rows nor add any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ruleweave.defaults import PSEUDO_FRACTION, SEED, TRAIN_BATCH_SIZE, WARMUP_SHARE
from ruleweave.functions.draws import draw, draw_bucket, permuted
from ruleweave.operators.stages import lookup_join

# 4,096 buckets per stratum: a stratum of ten billion rows ranks 2.4 million narrow ones.
STRATUM_BITS = 12
# One stratum only, so more buckets; their count table holds at most 65,536 rows whatever the data.
SINGLE_BITS = 16
# Rows among which the end of a head is sorted out; ranges of the id are narrowed to about so many.
HEAD_ROWS = 1_000_000
HEAD_RANGES = 64


def _tie_break(df: DataFrame) -> Column:
    """A digest of the whole row, so that rows with equal ids have an order of their own."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])


def _keep_lowest(
    df: DataFrame,
    stratum: Column | None,
    order: Column,
    id_col: str,
    bits: int,
    quota: Callable[[Column], Column],
) -> DataFrame:
    """The first ``quota(n)`` rows of each stratum of ``n`` rows, by (draw, id with nulls last, digest of the row)."""
    one = stratum is None
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), order.alias("_order"), F.col(id_col).alias("_id"), _tie_break(df).alias("_tie"), (F.lit(0) if one else stratum).alias("_stratum"))
    marked = marked.withColumn("_bucket", draw_bucket(F.col("_order"), bits))
    counts = marked.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_stratum")
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        counts.withColumn("_last", F.sum("_n").over(upto))
        .withColumn("_quota", quota(F.sum("_n").over(whole)))
        .withColumn("_before", F.col("_last") - F.col("_n"))
        .filter((F.col("_before") < F.col("_quota")) & (F.col("_last") >= F.col("_quota")))
        .select("_stratum", F.col("_bucket").alias("_cut"), (F.col("_quota") - F.col("_before")).alias("_need"))
    )
    if one:
        cut = cuts.first()
        if cut is None:
            return df.filter("false")
        found = marked.withColumn("_cut", F.lit(cut["_cut"])).withColumn("_need", F.lit(cut["_need"]))
    else:
        found = lookup_join(marked, cuts, ["_stratum"], "inner", spread_by="_order")
    below = found.filter(F.col("_bucket") < F.col("_cut"))
    ranked = found.filter(F.col("_bucket") == F.col("_cut")).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_stratum").orderBy("_order", F.col("_id").asc_nulls_last(), "_tie"))
    )
    return below.select("_row").union(ranked.filter(F.col("_rank") <= F.col("_need")).select("_row")).select("_row.*")


def stratified_sample(
    df: DataFrame,
    stratum_col: str = "rule",
    frac: float = PSEUDO_FRACTION,
    *,
    id_col: str = "row_id",
    tag: str = "pseudo",
    seed: int = SEED,
    bits: int = STRATUM_BITS,
) -> DataFrame:
    """Exactly ``round(frac * n)`` rows of each stratum, half to even; rows without a stratum are dropped."""
    return _keep_lowest(
        df.filter(F.col(stratum_col).isNotNull()),
        F.col(stratum_col),
        draw(tag, id_col, seed=seed),
        id_col,
        bits,
        lambda n: F.bround(F.lit(float(frac)) * n, 0).cast("long"),
    )


def sample_n(
    df: DataFrame, n: int, *, id_col: str = "row_id", tag: str = "subsample", seed: int = SEED
) -> DataFrame:
    """``n`` rows without replacement; all rows if there are no more than that."""
    return _keep_lowest(
        df,
        None,
        draw(tag, id_col, seed=seed),
        id_col,
        SINGLE_BITS,
        lambda rows: F.least(F.lit(n).cast("long"), rows),
    )


def sample_fraction(
    df: DataFrame, fraction: float, *, id_col: str = "row_id", tag: str = "subsample", seed: int = SEED
) -> DataFrame:
    """Exactly ``round(fraction * n)`` of ``n`` rows, half to even."""
    return _keep_lowest(
        df,
        None,
        draw(tag, id_col, seed=seed),
        id_col,
        SINGLE_BITS,
        lambda rows: F.bround(F.lit(float(fraction)) * rows, 0).cast("long"),
    )


def head_n(df: DataFrame, n: int | None, *, id_col: str = "row_id") -> DataFrame:
    """The ``n`` rows with the smallest ids of any orderable type, nulls last; no limit if ``n`` is 0 or None.

    Of rows with equal ids those with the smaller digest come first. Drawn ids cut the table into ranges; counts per range tell
    which one holds the last row, and it is cut again until it is small. Rows before it are kept by a filter.
    """
    if not n:
        return df
    key = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("v"))
    inside, need = F.lit(True), n
    below = F.lit(False)
    while (rows := df.filter(inside).count()) > max(HEAD_ROWS, 1) and need < rows:
        part = df.filter(inside).select(key.alias("k"))
        drawn = part.sample(min(1.0, 40.0 * HEAD_RANGES / rows), seed=SEED).distinct().sort("k").collect()
        ends = [r["k"]["v"] for r in drawn[:: max(1, len(drawn) // HEAD_RANGES)] if not r["k"]["n"]]
        kind = df.schema[id_col].dataType
        # Range i holds the ids above end i - 1 up to end i; the last one also holds the nulls.
        place = F.coalesce(F.size(F.filter(F.array(*[F.lit(e).cast(kind) for e in ends]), lambda e: e < F.col(id_col))), F.lit(len(ends)))
        place = F.when(F.col(id_col).isNull(), F.lit(len(ends))).otherwise(place)
        counts = dict(sorted((r["p"], r["n"]) for r in df.filter(inside).groupBy(place.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()))
        at = before = 0
        for at, size in counts.items():
            if before + size >= need:
                break
            before += size
        if counts[at] == rows:
            break
        below = below | (inside & (place < at))
        inside, need = inside & (place == at), need - before
    if need >= rows:
        return df.filter(below | inside)
    last = df.filter(inside).withColumn("_tie", _tie_break(df)).orderBy(F.col(id_col).asc_nulls_last(), "_tie").limit(need)
    return df.filter(below).unionByName(last.drop("_tie"))


def shuffle_batches(
    df: DataFrame,
    *,
    id_cols: list[str],
    batch_size: int = TRAIN_BATCH_SIZE,
    epochs: int | None = None,
    tag: str = "batches",
    seed: int = SEED,
) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos``: a random order of all rows, cut into batches of ``batch_size``.

    With ``epochs`` each row comes that many times, told apart by ``epoch`` (from 0), in another order each time. The rows are
    numbered once, by the order of the first epoch; later ones permute the numbers, without a sort or a shuffle.
    """
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), draw(tag, *id_cols, seed=seed).alias("_draw")
    ).withColumn("_bucket", draw_bucket(F.col("_draw"), SINGLE_BITS))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most 2**SINGLE_BITS narrow rows, so both the windows and the broadcast are bounded.
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), F.sum("_n").over(Window.partitionBy()).alias("_all")
    )
    order = [F.col("_draw"), *[F.col("_row").getField(c) for c in id_cols]]
    within = Window.partitionBy("_bucket").orderBy(*order)
    placed = rows.join(F.broadcast(offsets), "_bucket").withColumn("_ix", F.col("_offset") + F.row_number().over(within) - 1)
    place, more = F.col("_ix"), []
    if epochs is not None:
        placed = placed.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        again = permuted(F.col("_ix"), F.col("_all"), f"{tag}-epoch", "_epoch", seed=seed)
        placed = placed.withColumn("_ix", F.when(F.col("_epoch") == 0, F.col("_ix")).otherwise(again))
        more = [F.col("_epoch").alias("epoch")]
    return placed.select(
        *[F.col("_row").getField(c).alias(c) for c in df.columns],
        *more,
        F.floor(place / batch_size).cast("long").alias("batch_id"),
        (place % batch_size).cast("int").alias("batch_pos"),
    )


def batch_plan(df: DataFrame, *, batch_size: int = TRAIN_BATCH_SIZE, epochs: int = 1) -> DataFrame:
    """One row: number of rows, batches (the last may be short) and warm-up steps."""
    batches = F.ceil(F.col("n_rows") / batch_size).cast("long")
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("n_batches", batches)
        .withColumn(
            "warmup_steps",
            F.floor((F.col("n_batches") * epochs).cast("double") * F.lit(WARMUP_SHARE)).cast("long"),
        )
    )


__all__ = [
    "batch_plan",
    "head_n",
    "sample_fraction",
    "sample_n",
    "shuffle_batches",
    "stratified_sample",
]
