"""Merkle manifest of a dataset: a content-addressed tree over all rows, and proofs read from it from the root down.

Rows are leaves. The leaves of a source, by their order, are hashed in runs of ``FANOUT`` into parents, these again, until
one node, the subroot, remains; the subroots, by source, become the root in the same way. The tree is stored as records
(digest, children), so equal subtrees are one record. A request for a leaf descends from the root: the digits of its rank to
the base ``FANOUT`` name the child at each node, the children not taken are collected on the way, and the collected
segments are reversed into a proof from the leaf up. All requests descend together, one join of nodes with records per level,
so what is shared above them is read once.

Ranks come from a range sort and the row counts of its partitions, so no source is gathered in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.operators.stages import lookup_join, materialize

BITS = 4
FANOUT = 1 << BITS
# Records up to this many bytes are broadcast to a level of the descent.
BROADCAST_BYTES = 16 * 1024 * 1024
_PART_BITS = 33  # of monotonically_increasing_id: the row within its partition
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: each field as its UTF-8 byte count, a colon and its value, or ``-`` where it is missing."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``_number``, from 0 in the given order (nulls first). Rows equal in it are numbered in any order.

    Stored. The rows are sorted by ranges; a number is the row's place in its range and the counts of the ranges before.
    Rows that are equal throughout are dealt over several ranges by where they were read.
    """
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    ranged = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _PART_BITS)
    # As many rows as the sort had partitions.
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    joined = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn("_number", F.col("_before") + within).drop("_part", "_before", "_at")


@dataclass
class Tree:
    """Levels of (tree, rank, n, children, digest) above the bottom, the tops, and records (digest, children) by level."""

    records: list[DataFrame]
    tops: DataFrame


def _grow(nodes: DataFrame, most: int) -> Tree:
    """Reduce nodes (tree, rank, n, digest), ``n`` of them in a tree and at most ``most``, to one node each.

    ``tops`` holds (tree, height, digest), one row per tree.
    """
    records, height = [], 0
    tops = [nodes.filter("n = 1").select("tree", F.lit(0).alias("height"), "digest")]
    while most > 1:
        runs = nodes.filter("n > 1").groupBy("tree", "n", F.shiftright("rank", BITS).alias("rank"))
        runs = runs.agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("_run"))
        children = F.transform("_run", lambda x: x["digest"])
        fewer = F.shiftright(F.col("n") + (FANOUT - 1), BITS)
        nodes = materialize(
            runs.select("tree", "rank", fewer.alias("n"), children.alias("children")).withColumn(
                "digest", digest(F.concat_ws("", "children"))
            )
        )
        height, most = height + 1, (most + FANOUT - 1) >> BITS
        records.append(materialize(nodes.groupBy("digest").agg(F.first("children").alias("children"))))
        tops.append(nodes.filter("n = 1").select("tree", F.lit(height).alias("height"), "digest"))
    every = tops[0]
    for more in tops[1:]:
        every = every.unionByName(more)
    return Tree(records, every)


def _segment(place: Column) -> Column:
    """The children not taken, before and after the one taken."""
    before, after = F.slice("children", 1, place), F.slice("children", place + 2, FANOUT)
    return F.struct(F.concat_ws("", before).alias("before"), F.concat_ws("", after).alias("after"))


def _open(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """Nodes with the children that their digests stand for."""
    return lookup_join(frontier, records, ["digest"], "inner", spread_by="rank", stored=True, limit=BROADCAST_BYTES)


def _wanted(frontier: DataFrame, requests: DataFrame | None, level: int) -> DataFrame:
    """Only nodes that a requested leaf lies below."""
    if requests is None:
        return frontier
    prefixes = requests.select("tree", F.shiftright("rank", BITS * level).alias("rank")).distinct()
    return frontier.join(prefixes, ["tree", "rank"], "left_semi")


def _descend(tree: Tree, tops: DataFrame, requests: DataFrame | None) -> DataFrame:
    """(tree, rank, digest, path, ...): the nodes one level above the bottom, with the segments collected on the way.

    ``tops``: (tree, height, digest, path, ...). Trees of one leaf give their top, with no children.
    """
    columns = [c for c in tops.columns if c != "height"]
    frontier = None
    for level in range(len(tree.records), 0, -1):
        starts = tops.filter(F.col("height") == level).drop("height").withColumn("rank", F.lit(0).cast("long"))
        frontier = starts if frontier is None else frontier.unionByName(starts)
        opened = _open(_wanted(frontier, requests, level), tree.records[level - 1])
        if level == 1:
            frontier = opened
            break
        spread = opened.select(*columns, "rank", "children", F.posexplode("children").alias("_place", "_child"))
        path = F.concat("path", F.array(_segment(F.col("_place"))))
        rank = F.shiftleft("rank", BITS) + F.col("_place")
        changed = {"path": path, "rank": rank.cast("long"), "digest": F.col("_child")}
        frontier = materialize(spread.withColumns(changed).select(*columns, "rank"))
    alone = tops.filter("height = 0").drop("height")
    alone = alone.withColumns({"rank": F.lit(0).cast("long"), "children": F.lit(None).cast("array<string>")})
    return alone if frontier is None else frontier.unionByName(alone)


@dataclass
class Manifest:
    """The stored tree. ``leaves``: the given rows with tree (number of the source), rank in it and n (rows of the source);
    ``root``: the digest of all, None of an empty table."""

    leaves: DataFrame
    sources: Tree
    trees: Tree
    root: str | None


def build(rows: DataFrame, *, source: str = "source", order: list[str], leaf: str = "leaf") -> Manifest:
    """Tree over rows that hold their leaf digest. Leaves of a source go by ``order`` (nulls first), then by digest; sources
    by their bytes, a missing one first. Rows may repeat: each is a leaf of its own, and equal ones share their records.
    Further columns stay with the leaves; those named as the manifest's own are refused.
    """
    if clash := [c for c in rows.columns if c in ("tree", "rank", "n", "path", "subroot") or c.startswith("_")]:
        raise ValueError(f"columns clash with those of the manifest: {', '.join(clash)}")
    placed = numbered(rows, [source, *order, leaf])
    named = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`")), F.lit("n")).alias("_source")
    sources = placed.groupBy(named).agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("n"))
    sources = numbered(sources, ["_first"]).withColumnRenamed("_number", "tree")
    sources = materialize(sources)
    totals = sources.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("count")).first()
    placed = lookup_join(placed.select("*", named), sources, ["_source"], "inner", spread_by="_number", stored=True)
    leaves = materialize(placed.withColumn("rank", F.col("_number") - F.col("_first")).drop("_number", "_first", "_source"))
    trees = _grow(leaves.select("tree", "rank", "n", F.col(leaf).alias("digest")), totals["most"] or 0)
    tops = trees.tops.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.lit(totals["count"]).cast("long").alias("n"), "digest"
    )
    # Trees of one leaf have equal tops if their leaves are equal; the rank tells them apart.
    over = _grow(tops, totals["count"])
    root = over.tops.first()
    return Manifest(leaves, over, trees, root and root["digest"])


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: segments (before, after) of the children not taken, from the leaf to the root.

    ``requests``: (tree, rank) of the leaves wanted; None stands for all. Empty for an empty manifest.
    """
    leaves = manifest.leaves
    if requests is not None:
        requests = materialize(requests.select("tree", "rank").distinct())
        leaves = leaves.join(requests, ["tree", "rank"], "left_semi")
    root = manifest.sources.tops.select("tree", "height", "digest", F.array().cast(_PATH).alias("path"))
    above = None if requests is None else requests.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"))
    opened = _descend(manifest.sources, root, above)
    # Down to the subroots: the children of the last level, or the root itself where there is one source.
    taken = F.posexplode(F.coalesce("children", F.array("digest"))).alias("_place", "_child")
    spread = opened.select("rank", "children", "path", taken)
    segment = F.array(_segment(F.col("_place")))
    spread = spread.select(
        F.when(F.col("children").isNull(), 0).otherwise(F.shiftleft("rank", BITS) + F.col("_place")).cast("long").alias("tree"),
        F.col("_child").alias("digest"),
        F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", segment)).alias("path"),
    )
    tops = spread.join(manifest.trees.tops.select("tree", "height"), "tree")
    tops = materialize(tops.select("tree", "height", "digest", "path", F.col("digest").alias("subroot")))
    runs = _descend(manifest.trees, tops, requests).select("tree", F.col("rank").alias("_run"), "subroot", "path", "children")
    joined = leaves.withColumn("_run", F.shiftright("rank", BITS)).join(runs, ["tree", "_run"])
    place = F.col("rank").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    whole = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(_segment(place))))
    return joined.withColumn("path", F.reverse(whole)).drop("_run", "children")


def proof_digest(path: Column | str = "path") -> Column:
    """Digest of all segments of a proof, from the leaf up, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))))


def fold(leaf: Column, path: Column | str = "path") -> Column:
    """The root that a leaf has under a proof."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))
