"""Exact Jaccard work on shingle sets: which members of a bucket are linked, and how many links a document has.

Texts with equal shingle sets are one set with a number of copies. Buckets of sets come from a candidate search. Inside a
bucket, sets are compared without writing out pairs: a task reports a spanning forest of the links it finds, or sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import checked_join, document_key, text_or_empty
from ruleweave.llm.components import connected
from ruleweave.llm.shingles import hashes, shingle_hashes, text_words, word_table
from ruleweave.operators.stages import discard, materialize, store_bucketed

SIMILARITY = 0.8
# Sets in a bucket that is compared as it is.
SMALL = 64
# Sets that one task compares with each other; larger buckets are cut and their parts compared two by two.
PART = 1024
_COLUMNS = 4096


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 48-bit hashes of the shingles of a text, lower-cased."""
    return np.unique(shingle_hashes(hashes(text_words(text), word_table())) >> np.uint64(16))


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit key of a set, as a signed number; the empty set has 0."""
    if not len(shingles):
        return 0
    with np.errstate(over="ignore"):
        mixed = (shingles * np.uint64(0x9E3779B97F4A7C15)) ^ (shingles >> np.uint64(7))
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        total = (mixed ^ (mixed >> np.uint64(29))).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(total.astype(np.int64)) or 1


def pack(shingles: np.ndarray) -> bytes:
    """Six bytes per shingle: the lower 32 bits of all, then the upper 16 of all."""
    return shingles.astype("<u4").tobytes() + (shingles >> np.uint64(32)).astype("<u2").tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low, high = np.frombuffer(data, "<u4", n), np.frombuffer(data, "<u2", n, 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set."""
    if len(left) == 1 and len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    every = [*left, *right]
    owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
    shingles = np.concatenate(every)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    column = np.cumsum(np.concatenate(([True], shingles[1:] != shingles[:-1]))) - 1 if len(shingles) else owner
    # Shingles that one set has alone add nothing.
    shared = np.bincount(column)[column] > 1 if len(column) else column.astype(bool)
    column, owner = column[shared], owner[shared]
    column = np.unique(column, return_inverse=True)[1]
    total = np.zeros((len(left), len(right)))
    for at in range(0, int(column.max(initial=-1)) + 1, _COLUMNS):
        low, high = np.searchsorted(column, [at, at + _COLUMNS])
        block = np.zeros((len(every), _COLUMNS), np.float32)
        block[owner[low:high], column[low:high] - at] = 1
        total += block[: len(left)] @ block[len(left) :].T
    return total


def similar(left: list[np.ndarray], right: list[np.ndarray], least: float) -> np.ndarray:
    """Which pairs have at least the given Jaccard similarity. Two empty sets are alike."""
    both = overlaps(left, right)
    sizes = np.add.outer([len(x) for x in left], [len(x) for x in right])
    # Compared as whole numbers times the threshold, so that no division rounds.
    return both >= least * (sizes - both) - 1e-9


def forest(keys: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets.

    Sets that are linked already, if through others, are not compared again: in a dense bucket almost all are linked after
    the first rows.
    """
    root = np.arange(len(keys))
    edges = []
    for at in range(0, len(keys), 16):
        mine = np.arange(at, min(at + 16, len(keys)))
        other = np.arange(at + 1, len(keys))
        if len(set(root[mine].tolist())) == 1:
            other = other[root[other] != root[at]]
        if not len(other):
            continue
        found = similar([sets[i] for i in mine], [sets[i] for i in other], least)
        for a, b in zip(*np.nonzero(found)):
            i, j = mine[a], other[b]
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                edges.append((int(keys[i]), int(keys[j])))
    return edges


def parts_of(members: DataFrame, sizes: DataFrame, part: int = PART) -> DataFrame:
    """(bucket, pair, key, part): buckets of (bucket, key), larger ones cut into parts, each pair of which is a unit.

    ``sizes`` holds (bucket, n). A bucket within ``part`` is one unit.
    """
    counted = members.join(sizes, "bucket").withColumn("_parts", F.ceil(F.col("n") / part).cast("int"))
    counted = counted.withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), F.col("_parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    paired = counted.withColumn("_other", other)
    pair = F.least("part", "_other") * F.col("_parts") + F.greatest("part", "_other")
    return paired.select("bucket", pair.cast("int").alias("pair"), "key", "part")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Units of rows sorted by (bucket, pair): the keys, parts, copies and sets of each."""
    now, rows = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for bucket, pair, key, part, copies, data in zip(*columns):
            if now != (bucket, pair):
                if rows:
                    yield now, rows
                now, rows = (bucket, pair), []
            rows.append((key, part, copies, data))
    if rows:
        yield now, rows


def _unit(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    keys, parts, copies = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    return keys, parts, copies, [unpack(r[3]) for r in rows]


def _batches(found: Iterator[tuple[int, ...]], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    while rows := list(islice(found, 50_000)):
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], list(names))


def _edges(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    def found():
        for _, rows in _groups(batches):
            keys, parts, _, sets = _unit(rows)
            for u, v in forest(keys, sets, least):
                yield u, v, int(parts[0])

    yield from _batches(found(), ("u", "v", "part"))


def _links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Linked documents of each set of a unit, copies counted: in the other part, or in its own if there is one."""

    def found():
        for _, rows in _groups(batches):
            keys, parts, copies, sets = _unit(rows)
            names = sorted(set(parts.tolist()))
            sides = [np.flatnonzero(parts == name) for name in names]
            if len(sides) == 1:
                sides = [sides[0], sides[0]]
            for at in range(0, len(sides[0]), 256):
                mine = sides[0][at : at + 256]
                alike = similar([sets[i] for i in mine], [sets[i] for i in sides[1]], least)
                if len(names) == 1:
                    alike &= mine[:, None] != sides[1][None, :]
                else:
                    yield from zip(keys[sides[1]].tolist(), (alike.T @ copies[mine]).tolist())
                yield from zip(keys[mine].tolist(), (alike @ copies[sides[1]]).tolist())

    yield from _batches(((k, n) for k, n in found() if n), ("key", "links"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, copies, data = [], [], []
        wanted, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            shingles = shingle_set(batch.column(2)[i].as_py())
            if set_key(shingles) == wanted[i]:
                keys.append(wanted[i])
                copies.append(counts[i])
                data.append(pack(shingles))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(copies, pa.int64()), pa.array(data, pa.binary())],
            ["key", "copies", "data"],
        )


def fetch_sets(docs: DataFrame, wanted: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(key, copies, data) for the wanted (key, copies, doc, text_hash) sets, from the texts of their documents ``doc``.

    Ids may repeat, so a text is named by its hash as well, and taken only if its set has the wanted key.
    """
    text = text_or_empty(text_col)
    texts = docs.select(document_key(id_col).alias("_doc"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    named = wanted.select("key", "copies", document_key("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    joined = checked_join(texts, materialize(named), ["_doc", "_hash"])
    return joined.select("key", "copies", "_text").mapInArrow(_sets, "key long, copies long, data binary")


def run_units(units: DataFrame, sets: DataFrame, task: Callable, schema: str, *, similarity: float = SIMILARITY) -> DataFrame:
    """Run ``task`` over all units (bucket, pair, key, part) with their sets, the members of a unit together."""
    rows = units.join(sets, "key").select("bucket", "pair", "key", "part", "copies", "data")
    rows = rows.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair", "key")
    return rows.mapInArrow(partial(task, least=similarity), schema)


def linked_edges(units: DataFrame, sets: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v, part): edges that connect all sets of a bucket that links connect, with a part of their unit."""
    return run_units(units, sets, _edges, "u long, v long, part long", similarity=similarity)


def link_counts(units: DataFrame, sets: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """(key, links): documents of other sets that a set is linked with, if each two sets share one unit."""
    counted = run_units(units, sets, _links, "key long, links long", similarity=similarity)
    return counted.groupBy("key").agg(F.sum("links").alias("links"))


def distinct_sets(scanned: DataFrame, carried: list[str]) -> DataFrame:
    """(key, copies, doc, text_hash, ...) of (doc_id, text_hash, key, ...) rows: equal sets once, with the least id, the hash of a
    text under it, and the carried columns."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("_least")
    found = scanned.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), least, *[F.first(c).alias(c) for c in carried])
    doc, text_hash = F.col("_least.doc_id").alias("doc"), F.col("_least.text_hash").alias("text_hash")
    return found.select("key", "copies", doc, text_hash, *carried)


def stored_sets(scanned: DataFrame, carried: list[str]) -> DataFrame:
    """``distinct_sets``, stored in buckets of the key: what joins them moves to the sets, and the sets stay where they are."""
    return store_bucketed(distinct_sets(scanned, carried), "key", dealt=True)


def bucket_sizes(members: DataFrame) -> DataFrame:
    """(bucket, n) of the buckets with more than one member."""
    return members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def small_units(members: DataFrame, sizes: DataFrame, small: int = SMALL, *, marks: Column | None = None) -> DataFrame:
    """(bucket, pair, key, part) of buckets with at most ``small`` members; buckets with the same members count once.

    ``part`` is 0, or the marks of those buckets, combined by their bits.
    """
    marks = F.lit(0) if marks is None else marks
    within = members.join(sizes.filter(F.col("n") <= small), "bucket")
    gathered = within.groupBy("bucket").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    once = gathered.groupBy("keys").agg(F.min("bucket").alias("bucket"), F.bit_or(marks).alias("part"))
    return once.select("bucket", F.lit(0).alias("pair"), F.explode("keys").alias("key"), "part")


def fetch_members(docs: DataFrame, units: DataFrame, sets: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(key, copies, data) of the sets in units."""
    wanted = units.select("key").distinct().join(sets.select("key", "copies", "doc", "text_hash"), "key")
    return fetch_sets(docs, wanted, id_col=id_col, text_col=text_col).dropDuplicates(["key"])


def stored_members(docs: DataFrame, units: DataFrame, sets: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``fetch_members``, stored in buckets of the key like the sets."""
    return store_bucketed(fetch_members(docs, units, sets, id_col=id_col, text_col=text_col), "key", dealt=True)


def classes(
    docs: DataFrame,
    scanned: DataFrame,
    sets: DataFrame,
    units: list[DataFrame],
    *,
    similarity: float,
    id_col: str,
    text_col: str,
    count_links: bool,
) -> DataFrame:
    """The rows of ``class_rows``, from stored units of sets to compare."""
    every = units[0]
    for more in units[1:]:
        every = every.unionByName(more)
    data = stored_members(docs, every, sets, id_col=id_col, text_col=text_col)
    edges = materialize(linked_edges(every, data, similarity=similarity))
    for unit in units:
        discard(unit)
    roots = materialize(connected(edges))
    discard(edges)
    return class_rows(scanned, sets, roots, data, similarity=similarity, count_links=count_links)


def class_rows(
    scanned: DataFrame, sets: DataFrame, roots: DataFrame, data: DataFrame, *, similarity: float, count_links: bool
) -> DataFrame:
    """(doc_id, text_hash, class_key, class_id, n_links): one row per document, from the stored roots of linked sets.

    ``class_key`` names the class, a connected component of links; ``class_id`` is the least document id in it and
    ``n_links`` the number of other documents whose set has at least the given similarity, copies included (null if
    ``count_links`` is off). Words are runs between ASCII white space with A-Z lowered; a text with fewer than five is one
    shingle. Missing texts count as empty, and empty texts are copies of each other. Null ids are kept; a class of null ids only
    has a null class id. Repeated rows count each.

    Links are counted inside classes, where all of them lie: each two sets of a class are compared once, in parts.
    """
    linked = roots.union(roots.select("root", "root").distinct()).toDF("key", "root")
    classes = materialize(
        sets.select("key", "copies", "doc").join(linked, "key", "left").select("key", "copies", "doc", F.coalesce("root", "key").alias("root"))
    )
    named = classes.groupBy("root").agg(F.min("doc").alias("class_id"))
    summary = classes.join(named, "root").select(
        "key", F.col("root").alias("class_key"), "class_id", (F.col("copies") - 1).alias("_own")
    )
    if count_links:
        inside = linked.select(F.col("root").alias("bucket"), "key")
        class_sizes = materialize(inside.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
        links = materialize(
            link_counts(parts_of(inside, class_sizes), data, similarity=similarity)
        )
        discard(class_sizes)
        summary = summary.join(links, "key", "left").select(
            "key", "class_key", "class_id", (F.col("_own") + F.coalesce("links", F.lit(0))).alias("n_links")
        )
    else:
        summary = summary.select("key", "class_key", "class_id", F.lit(None).cast("long").alias("n_links"))
    summary = materialize(summary)
    for stored in (data, sets, classes):
        discard(stored)
    rows = scanned.select("doc_id", "text_hash", "key").join(summary, "key")
    return rows.select("doc_id", "text_hash", "class_key", "class_id", "n_links")
