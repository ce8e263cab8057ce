"""N-gram Jaccard join by chosen paths.

Every set of 5-word shingles picks a few of its shingles by a hash that all sets share; sets that pick the same one meet
in a bucket. A small bucket is compared exactly. A large one is split again on further shingles picked by hashes of the path so
far, until it is small or its members are so alike that splitting does not help.

Runs with other hashes are repeated until the target recall. A round is 8 runs of 2 picks, in two halves that share no hash. Of
the links that the second half finds, those that nothing before it connects are the share still missed; while it is above
``1 - recall``, another round follows, with picks and sketches of its own.

Texts with equal shingle sets are one set from the start. Picks depend on a set alone, so a level moves only
(path, set) pairs of 16 bytes. Links give classes as connected components; then the links of every document are counted
inside its class, where all of them lie. No pair of documents is ever written as a row.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.llm import jaccard
from ruleweave.llm.common import checked_join, text_or_empty
from ruleweave.llm.components import connected
from ruleweave.llm.shingles import stir
from ruleweave.operators.stages import discard, materialize, store_bucketed


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Paths:
    """``runs``: in a round, an even number. ``recall``: share of the last half round's links that must be known before it. ``small``: sets in a bucket that is compared as it is. ``alike``: share of a bucket that may meet again below it
    before it counts as one of alike sets. ``sketch``: sampled shingles per set, ``sketch / runs`` for the lower levels of each
    run. ``agree``: share of places in which near sets of ``asked`` shingles at least must agree."""

    runs: int = 8
    recall: float = 0.99
    picks: float = 2.0
    small: int = jaccard.SMALL
    alike: float = 0.5
    levels: int = 6
    sketch: int = 128
    agree: float = 0.5
    asked: int = 128
    similarity: float = jaccard.SIMILARITY


# Runs of a round are told by the low bits of a path.
_RUN_BITS = 6


@lru_cache(16)
def _factors(number: int) -> np.ndarray:
    """Odd factors of a round: multiplied shingles, themselves hashes, are independent enough draws. The last one is the sketch's."""
    return np.random.default_rng([8, number]).integers(1, 1 << 62, 65, np.uint64) * np.uint64(2) + np.uint64(1)


def half_mark(bucket: str) -> Column:
    """1 or 2: the half of the round that the path of a bucket belongs to, for runs in turn."""
    return (F.col(bucket).bitwiseAND(1) + 1).cast("int")


def first_paths(shingles: np.ndarray, p: Paths, number: int = 0) -> np.ndarray:
    """The first-level path hashes of a set: each run of the round takes each shingle with probability picks / size."""
    factors = _factors(number)
    limit = np.uint64(min(1.0, p.picks / len(shingles)) * float((1 << 64) - 1025))
    found = []
    for run in range(p.runs):
        drawn = shingles * factors[run]
        found.append(_named(stir(drawn[drawn <= limit]), run))
    return np.concatenate(found)


def _named(paths: np.ndarray, run: int) -> np.ndarray:
    return (paths << np.uint64(_RUN_BITS)) | np.uint64(run)


def sketch_of(shingles: np.ndarray, p: Paths, number: int = 0) -> np.ndarray:
    """Least hash in each of ``sketch`` equal ranges of hashes, 16 bits of it; an empty range takes that of the next one.

    Two sets agree in a place about as often as their similarity says.
    """
    drawn = np.sort(shingles * _factors(number)[-1])
    width = np.uint64((1 << 64) // p.sketch)
    ends = np.searchsorted(drawn, np.arange(1, p.sketch, dtype=np.uint64) * width)
    starts = np.concatenate(([0], ends))
    full = np.flatnonzero(np.append(ends, len(drawn)) > starts)
    places = np.arange(p.sketch)
    after = np.searchsorted(full, places)
    taken = full[after % len(full)]
    away = (taken - places) % p.sketch
    return ((drawn[starts[taken]] >> np.uint64(8)) + away.astype(np.uint64) * np.uint64(0x9E37)).astype(np.uint16)


def next_paths(path: int, sketch: np.ndarray, p: Paths) -> np.ndarray:
    """The paths below ``path`` that its run's part of a sketch picks, each place with probability picks / places."""
    run = path & ((1 << _RUN_BITS) - 1)
    own = sketch[run :: p.runs].astype(np.uint64)
    tokens = (np.arange(len(own), dtype=np.uint64) << np.uint64(16)) | own
    drawn = stir(tokens ^ np.array([path], np.int64).astype(np.uint64))
    limit = np.uint64(min(1.0, p.picks / len(own)) * float((1 << 64) - 1025))
    return _named(stir(drawn[drawn <= limit] + np.uint64(77)), run)


def _scan(batches: Iterator[pa.RecordBatch], p: Paths, number: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, paths, sketches = [], [], [], []
        for text in batch.column(2):
            shingles = jaccard.shingle_set(text.as_py())
            keys.append(jaccard.set_key(shingles))
            sizes.append(len(shingles))
            some = len(shingles) > 0
            paths.append(first_paths(shingles, p, number).astype(np.int64) if some else [])
            sketches.append(sketch_of(shingles, p, number).astype("<u2").tobytes() if some else b"")
        made = [
            pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(paths, pa.list_(pa.int64())), pa.array(sketches, pa.binary())
        ]
        names = ["doc_id", "text_hash", "key", "size", "paths", "sketch"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names)


def near_members(sizes: np.ndarray, sketches: np.ndarray, p: Paths) -> np.ndarray:
    """Which sets have another one that may be linked with them."""
    found = np.zeros(len(sizes), bool)
    for at in range(0, len(sizes), 64):
        rows = slice(at, at + 64)
        less = np.minimum.outer(sizes[rows], sizes)
        near = less >= p.similarity * np.maximum.outer(sizes[rows], sizes) - 1e-9
        near[np.arange(len(near)), np.arange(at, at + len(near))] = False
        a, b = np.nonzero(near)
        for part in range(0, len(a), 4096):
            i, j = a[part : part + 4096], b[part : part + 4096]
            agreed = (sketches[at + i] == sketches[j]).mean(axis=1)
            keep = (agreed >= p.agree) | (less[i, j] < p.asked)
            found[at + i[keep]] = True
            found[j[keep]] = True
    return found


def _near(batches: Iterator[pa.RecordBatch], least: float, p: Paths) -> Iterator[pa.RecordBatch]:
    """Units of (key, mark, size, sketch) rows, cut down to near members and named by them."""
    names = ["bucket", "key", "part"]
    buckets, keys, marks = [], [], []
    for _, rows in jaccard._groups(batches):
        sizes = np.array([r[2] for r in rows], np.int64)
        sketches = np.frombuffer(b"".join(r[3] for r in rows), "<u2").reshape(len(rows), p.sketch)
        kept = np.array([r[0] for r in rows], np.int64)[near_members(sizes, sketches, p)]
        if len(kept) < 2:
            continue
        kept = np.unique(kept)
        keys.append(kept)
        buckets.append(np.full(len(kept), jaccard.set_key(kept.astype(np.uint64)), np.int64))
        marks.append(np.full(len(kept), rows[0][1], np.int32))
        if sum(map(len, keys)) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (buckets, keys, marks)], names)
            buckets, keys, marks = [], [], []
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (buckets, keys, marks)], names)


def near_units(units: list[DataFrame], sets: DataFrame, p: Paths) -> DataFrame:
    """Units (bucket, pair, key, part) of the sets that may be linked; units of the same sets are one, with the marks of all."""
    every = units[0]
    for more in units[1:]:
        every = every.unionByName(more)
    known = sets.select("key", F.col("size").alias("copies"), F.col("sketch").alias("data"))
    kept = jaccard.run_units(every, known, partial(_near, p=p), "bucket long, key long, part int", similarity=p.similarity)
    once = kept.groupBy("bucket", "key").agg(F.bit_or("part").alias("part"))
    return once.select("bucket", F.lit(0).alias("pair"), "key", "part")


def _descend(batches: Iterator[pa.RecordBatch], p: Paths) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parents, paths, keys = [], [], []
        for path, key, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for below in next_paths(path, np.frombuffer(data, "<u2"), p).astype(np.int64).tolist():
                parents.append(path)
                paths.append(below)
                keys.append(key)
        columns = [pa.array(values, pa.int64()) for values in (parents, paths, keys)]
        yield pa.RecordBatch.from_arrays(columns, ["parent", "bucket", "key"])


def candidate_units(sets: DataFrame, p: Paths) -> list[DataFrame]:
    """Stored units (bucket, pair, key, part) of sets to compare, from stored (key, paths, sketch) rows; ``part`` is their mark."""
    mark = half_mark("bucket")
    drawn = sets.select(F.explode("paths").alias("bucket"), "key")
    sizes = materialize(jaccard.bucket_sizes(drawn))
    # Most paths are those of one set alone; these rows move once and are not kept.
    members = materialize(drawn.join(sizes.select("bucket"), "bucket", "left_semi"))
    units = []
    for level in range(1, p.levels + 1):
        units.append(materialize(jaccard.small_units(members, sizes, p.small, marks=mark)))
        large = sizes.filter(F.col("n") > p.small)
        if large.isEmpty():
            break
        inside = members.join(large.select("bucket"), "bucket").select("bucket", "key")
        if level == p.levels:
            units.append(materialize(jaccard.parts_of(inside, large).withColumn("part", mark)))
            break
        rows = inside.join(sets.select("key", "sketch"), "key").select("bucket", "key", "sketch")
        schema = "parent long, bucket long, key long"
        below = materialize(rows.mapInArrow(partial(_descend, p=p), schema))
        counts = materialize(
            below.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent")).filter(F.col("n") > 1)
        )
        most = counts.groupBy("parent").agg(F.max("n").alias("most")).withColumnRenamed("parent", "bucket")
        # Most of the members meet again below: they are alike, and are compared here.
        dense = materialize(large.join(most, "bucket", "left").filter(F.coalesce("most", F.lit(0)) >= p.alike * F.col("n")).select("bucket", "n"))
        units.append(materialize(jaccard.parts_of(inside.join(dense.select("bucket"), "bucket"), dense).withColumn("part", mark)))
        open_counts = counts.join(dense.select(F.col("bucket").alias("parent")), "parent", "left_anti")
        next_sizes = materialize(open_counts.select("bucket", "n"))
        discard(sizes)
        discard(members)
        members, sizes = below.select("bucket", "key"), next_sizes
        members.staged_path = below.staged_path
    discard(sizes)
    discard(members)
    return units


def _root(edges: DataFrame, roots: DataFrame, end: str) -> DataFrame:
    """The edges with the root of one end in its place."""
    known = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
    return checked_join(edges, known, [end], "left").withColumn(end, F.coalesce("_root", end)).drop("_root")


def add_links(roots: DataFrame | None, edges: DataFrame) -> tuple[DataFrame, float]:
    """Stored (node, root) rows that (u, v) links extend, and the share of these links that the old rows did not connect."""
    if roots is None:
        return materialize(connected(edges).toDF("node", "root")), 1.0
    links = edges.select("u", "v").distinct().count()
    fresh = materialize(_root(_root(edges.select("u", "v"), roots, "u"), roots, "v").filter(F.col("u") != F.col("v")).distinct())
    unknown = fresh.count()
    if unknown:
        more = materialize(connected(fresh).toDF("node", "root"))
        # Roots are the least nodes of their classes, so those of joined classes are too.
        raised = checked_join(roots, more.toDF("root", "_root"), ["root"], "left").select("node", F.coalesce("_root", "root").alias("root"))
        extended = materialize(raised.unionByName(more))
        discard(roots)
        discard(more)
        roots = extended
    discard(fresh)
    return roots, unknown / max(1, links)


def jaccard_classes(
    docs: DataFrame, p: Paths = Paths(), *, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True
) -> DataFrame:
    """(doc_id, text_hash, class_key, class_id, n_links) by chosen paths; see ``jaccard.class_rows`` for the columns.

    Rounds go on until ``p.recall`` is reached. Each logs the share of its second half's links that were unknown before.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("key", T.LongType()),
            T.StructField("size", T.LongType()),
            T.StructField("paths", T.ArrayType(T.LongType())),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    data, roots, missed, number = [], None, 1.0, 0
    while number == 0 or missed > 1 - p.recall:
        scanned = materialize(texts.mapInArrow(partial(_scan, p=p, number=number), schema))
        sets = jaccard.stored_sets(scanned, ["size", "paths", "sketch"])
        if number == 0:
            first, rows = sets, materialize(scanned.select("doc_id", "text_hash", "key"))
        discard(scanned)
        candidates = candidate_units(sets, p)
        units = materialize(near_units(candidates, sets, p))
        for stored in candidates:
            discard(stored)
        members = jaccard.stored_members(docs, units, sets, id_col=id_col, text_col=text_col)
        edges = materialize(jaccard.linked_edges(units, members, similarity=p.similarity))
        discard(units)
        for mark in (1, 2):
            roots, missed = add_links(roots, edges.filter(F.col("part").bitwiseAND(mark) > 0))
        discard(edges)
        log.info("round %d: %.5f of the links of its second half were unknown", number, missed)
        if number:
            discard(sets)
        data.append(members)
        number += 1
    every = data[0]
    if len(data) > 1:
        # The files are read as they are: Spark takes a union of bucketed tables as dealt by the key, but need not read it so.
        plain = [docs.sparkSession.read.schema(stored.schema).parquet(stored.staged_path) for stored in data]
        every = store_bucketed(reduce(DataFrame.unionByName, plain).dropDuplicates(["key"]), "key", dealt=True)
        for stored in data:
            discard(stored)
    return jaccard.class_rows(rows, first, roots, every, similarity=p.similarity, count_links=count_links)
