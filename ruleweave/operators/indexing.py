"""Dense numbering of a pool of rows in nested blocks (rule, then community), for random picks by equi-join.

Numbers run 0, 1, 2, ... over the whole pool, ordered by rule key, community key, draw and id. All rows of a rule are
one contiguous range, and so are all rows of a community within it, so "any row but those of this block" is a
shift of the picked number and never a join on inequality.

No window spans a block: rows are ranked within (rule, community, bucket of the draw), and the start of every bucket
comes from prefix sums over the counts, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ruleweave.defaults import SEED
from ruleweave.functions.draws import draw, draw_bucket
from ruleweave.functions.text import digest
from ruleweave.operators.stages import lookup_join, materialize, skew_join

BLOCK_BITS = 12
# Key of the block of rows whose rule or community is missing. No digest is empty.
MISSING_KEY = ""


def block_key(value: Column | str) -> Column:
    return F.coalesce(digest(value), F.lit(MISSING_KEY))


def _before(window: Window, column: str) -> Column:
    """Sum of the earlier rows of a window."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _with_starts(table: DataFrame, group: list[str], key: str, size: str, name: str) -> DataFrame:
    """Add the sum of ``size`` over the smaller keys of the same group.

    It is summed in two steps, so that no task sees a whole group: over the 4,096 leading digits of the keys, then
    within each.
    """
    cut = table.withColumn("_shard", F.substring(key, 1, 3))
    shards = (
        cut.groupBy(*group, "_shard")
        .agg(F.sum(size).alias("_shard_rows"))
        .select(
            *group,
            "_shard",
            _before(Window.partitionBy(*group).orderBy("_shard"), "_shard_rows").alias("_shard_start"),
        )
    )
    if not group:
        # At most 4,097 rows of a few bytes.
        shards = F.broadcast(shards)
    within = Window.partitionBy(*group, "_shard").orderBy(key)
    return (
        cut.join(shards, [*group, "_shard"])
        .withColumn(name, F.col("_shard_start") + _before(within, size))
        .drop("_shard", "_shard_start")
    )


@dataclass(frozen=True)
class PoolIndex:
    """A numbered pool.

    rows:        pool_id, ix
    rules:       rule_key, rule_start, rule_rows
    communities: rule_key, community_key, community_start, community_rows
    total:       number of rows
    """

    rows: DataFrame
    rules: DataFrame
    communities: DataFrame
    total: int


def build_pool_index(
    pool: DataFrame,
    *,
    id_col: str = "row_id",
    rule_col: str = "rule",
    community_col: str = "subreddit",
    tag: str = "pool",
    seed: int = SEED,
    bits: int = BLOCK_BITS,
) -> PoolIndex:
    # Keys and ids only; the texts stay behind until the picks are known.
    keyed = pool.select(
        F.col(id_col).alias("pool_id"),
        block_key(rule_col).alias("rule_key"),
        block_key(community_col).alias("community_key"),
        draw(tag, id_col, seed=seed).alias("_draw"),
    ).withColumn("_bucket", draw_bucket(F.col("_draw"), bits))

    counts = materialize(keyed.groupBy("rule_key", "community_key", "_bucket").agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]

    per_rule = counts.groupBy("rule_key").agg(F.sum("_n").alias("rule_rows"))
    rules = materialize(_with_starts(per_rule, [], "rule_key", "rule_rows", "rule_start"))

    per_community = counts.groupBy("rule_key", "community_key").agg(F.sum("_n").alias("community_rows"))
    placed = _with_starts(per_community, ["rule_key"], "community_key", "community_rows", "_offset")
    communities = materialize(
        placed.join(rules, "rule_key").select(
            "rule_key",
            "community_key",
            (F.col("rule_start") + F.col("_offset")).alias("community_start"),
            "community_rows",
        )
    )

    block = ["rule_key", "community_key"]
    offsets = counts.withColumn("_offset", _before(Window.partitionBy(*block).orderBy("_bucket"), "_n"))
    starts = offsets.join(communities, block).select(
        *block, "_bucket", (F.col("community_start") + F.col("_offset")).alias("_start")
    )
    within = Window.partitionBy(*block, "_bucket").orderBy("_draw", "pool_id")
    rows = (
        keyed.withColumn("_rank", F.row_number().over(within))
        .join(starts, [*block, "_bucket"])
        .select("pool_id", (F.col("_start") + F.col("_rank") - 1).alias("ix"))
    )
    return PoolIndex(rows, rules, communities, total)


def _skip(pick: Column, start: Column, length: Column) -> Column:
    """Number of the ``pick``-th row outside the block [start, start + length)."""
    return F.when(pick < start, pick).otherwise(pick + length)


def _blocks_of(anchors: DataFrame, index: PoolIndex, *, id_col: str, communities: bool, how: str) -> DataFrame:
    """Anchors with the ranges of their rule and, if asked, of their community in it.

    A missing rule or community equals nothing, so such an anchor has no range of its own.
    """
    placed = lookup_join(anchors, index.rules, ["rule_key"], how, spread_by=id_col, stored=True)
    if communities:
        placed = lookup_join(
            placed, index.communities, ["rule_key", "community_key"], "left", spread_by=id_col, stored=True
        )
    return placed


def pick_partners(
    anchors: DataFrame,
    index: PoolIndex,
    *,
    positive: bool,
    negative: bool,
    id_cols: list[str],
    rule_col: str = "rule",
    community_col: str = "subreddit",
    keep: list[str] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(id_cols, role, pool_id): one random pool row per anchor and role. Columns to ``keep`` follow the ids.

    Role ``positive`` has the anchor's rule and another community, role ``negative`` another rule. An anchor with
    an empty pool in any of the asked roles gets no row at all.
    """
    carried = [*id_cols, *(keep or [])]
    keyed = anchors.select(
        *carried, digest(rule_col).alias("rule_key"), digest(community_col).alias("community_key")
    )
    # With a positive role an anchor whose rule the pool lacks can be dropped at once.
    placed = _blocks_of(
        keyed, index, id_col=id_cols[0], communities=positive, how="inner" if positive else "left"
    )
    roles = []
    possible = F.lit(True)
    if positive:
        own = F.coalesce(F.col("community_rows"), F.lit(0))
        size = F.col("rule_rows") - own
        pick = draw("positive", *id_cols, seed=seed) % size
        # The community's range relative to its rule; without one the skip never applies.
        start = F.coalesce(F.col("community_start") - F.col("rule_start"), F.col("rule_rows"))
        possible = possible & (size > 0)
        roles.append(
            F.struct(F.lit("positive").alias("role"), (F.col("rule_start") + _skip(pick, start, own)).alias("ix"))
        )
    if negative:
        own = F.coalesce(F.col("rule_rows"), F.lit(0))
        size = F.lit(index.total) - own
        pick = draw("negative", *id_cols, seed=seed) % size
        start = F.coalesce(F.col("rule_start"), F.lit(index.total))
        possible = possible & (size > 0)
        roles.append(F.struct(F.lit("negative").alias("role"), _skip(pick, start, own).alias("ix")))
    picks = placed.filter(possible).select(*carried, F.explode(F.array(*roles)).alias("_pick"))
    # A small pool is picked from very often, so a number may have any share of the picks.
    found = skew_join(
        picks.select(*carried, "_pick.role", "_pick.ix"), index.rows, ["ix"], "inner", spread_by=id_cols[0]
    )
    return found.select(*carried, "role", "pool_id")


def with_pool_sizes(
    anchors: DataFrame,
    pool: DataFrame,
    *,
    id_col: str = "row_id",
    rule_col: str = "rule",
    community_col: str = "subreddit",
) -> DataFrame:
    """Add ``positive_pool`` and ``negative_pool``, the numbers of candidates an anchor has on each side."""
    counts = materialize(
        pool.groupBy(block_key(rule_col).alias("rule_key"), block_key(community_col).alias("community_key")).agg(
            F.count(F.lit(1)).alias("community_rows")
        )
    )
    per_rule = counts.groupBy("rule_key").agg(F.sum("community_rows").alias("rule_rows"))
    total = counts.agg(F.coalesce(F.sum("community_rows"), F.lit(0)).alias("n")).first()["n"]
    keyed = anchors.withColumn("rule_key", digest(rule_col)).withColumn("community_key", digest(community_col))
    placed = lookup_join(keyed, per_rule, ["rule_key"], "left", spread_by=id_col)
    placed = lookup_join(placed, counts, ["rule_key", "community_key"], "left", spread_by=id_col, stored=True)
    own_rule = F.coalesce(F.col("rule_rows"), F.lit(0))
    own_community = F.coalesce(F.col("community_rows"), F.lit(0))
    return placed.select(
        *anchors.columns,
        (own_rule - own_community).alias("positive_pool"),
        (F.lit(total) - own_rule).alias("negative_pool"),
    )


def filter_nonempty_pool(anchors: DataFrame, pool: DataFrame, **columns: str) -> DataFrame:
    """Anchors that have a candidate on both sides."""
    sized = with_pool_sizes(anchors, pool, **columns)
    return sized.filter((F.col("positive_pool") > 0) & (F.col("negative_pool") > 0))
