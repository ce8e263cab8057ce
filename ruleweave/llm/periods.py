"""Maximal periodic stretches of words, found by tiles whose size follows the period.

A run is a stretch of words that repeats with a smallest period q, is at least ``max(LEAST_WORDS, LEAST_POWERS * q)`` words
long, and cannot be made longer by a neighbouring word.

Periods are taken by octaves [m, 2m), m a power of two. Tiles of an octave are laid around boundaries m words apart: m
words before the boundary, 5m behind it. Let X be the places of a run at which a word equals the one q behind it: X has at least 3q >=
3m places, so some boundary b has [b, b + 2m) inside X; the tiles of all such boundaries overlap and cover X. A tile is
solved on its own: a hash of the 2m words at b, met again q behind, tells that it holds a candidate (equal words have
equal hashes, so none is missed); then a Z-function from the boundary onwards and one backwards give how far the equality
reaches for every q of the octave, exactly. Fragments are brought together by document and period and stitched where they
touch. A stretch that repeats with q also does with its multiples, over the same words: the least period stands.

Documents longer than a section are dealt out as sections with margins, so that one long document is the work of many tasks:
the small octaves share their sections, the larger ones have sections of 16m words each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.llm.common import text_or_empty
from ruleweave.llm.shingles import stir
from ruleweave.operators.stages import materialize

LEAST_WORDS = 6
LEAST_POWERS = 4
# Words of a section; a power of two.
SECTION = 16_384
# Boundaries of a section per octave at least, so margins (6m words) are small beside it.
TILES = 16
# Bytes of texts and words in one Arrow batch that a task hands back.
BATCH_BYTES = 4 << 20

_FACTORS = np.random.default_rng(13).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)
PLAIN, TEXT, FRAGMENT, PART = range(4)


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words as equal numbers, within one text."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def prefix_lengths(s: list[int], stop: int) -> list[int]:
    """Z-function: at each place below ``stop``, how much of ``s`` from there on equals its beginning."""
    n = len(s)
    z = [0] * min(stop, n)
    if z:
        z[0] = n
    left = right = 0
    for i in range(1, len(z)):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(words: list[int], boundary: int, m: int) -> list[tuple[int, int, int]]:
    """(period, first, end) for each period in [m, 2m) with which 2m places from the boundary on, at least, agree.

    ``words``: the tile; first and end bound the places that equal the one a period behind, within m before the boundary and
    3m behind it.
    """
    onward = prefix_lengths(words[boundary:], 2 * m)
    found = [q for q in range(m, len(onward)) if onward[q] >= 2 * m]
    if not found:
        return []
    before = words[:boundary][::-1]
    ends = words[: boundary + 2 * m - 1][::-1]
    # A word that no text has parts the pattern from the text.
    backward = prefix_lengths([*before, -1, *ends], len(before) + 1 + len(ends))[len(before) + 1 :]
    last = len(ends) - boundary
    return [(q, boundary - backward[last - q], boundary + min(onward[q], 3 * m)) for q in found]


def octave_windows(numbers: np.ndarray, levels: int) -> Iterator[np.ndarray]:
    """Hashes of all windows of 2, 4, ... 2 ** levels words."""
    h = stir(numbers.astype(np.uint64) + np.uint64(1))
    for level in range(levels):
        width = 1 << level
        h = h[:-width] * _FACTORS[level] + h[width:] if len(h) > width else h[:0]
        yield h


def fragments(
    numbers: np.ndarray, first_octave: int, last_octave: int, origin: int, begin: int, size: int
) -> Iterator[tuple[int, int, int]]:
    """(period, first, end) of the periodic places that boundaries in [begin, begin + size) find, joined where they touch.

    ``numbers`` are the words from ``origin`` on, margins included; all places are places in the document.
    """
    listed = None
    for octave, windows in enumerate(octave_windows(numbers, last_octave + 1)):
        if octave < first_octave or not len(windows):
            continue
        m = 1 << octave
        at = begin - origin
        count = min(-(-size // m), (len(windows) - 1 - at) // m + 1)
        if count <= 0:
            continue
        marks = windows[at : at + count * m : m]
        behind = np.zeros(count * m, np.uint64)
        given = windows[at + m : at + (count + 1) * m]
        behind[: len(given)] = given
        hits = np.flatnonzero((behind.reshape(count, m) == marks[:, None]).any(axis=1))
        if not len(hits):
            continue
        listed = numbers.tolist() if listed is None else listed
        stretches: dict[int, list[list[int]]] = {}
        for boundary in (at + hits * m).tolist():
            start = max(0, boundary - m)
            for q, first, end in solve_tile(listed[start : boundary + 5 * m], boundary - start, m):
                known = stretches.setdefault(q, [])
                if known and start + first <= known[-1][1]:
                    known[-1][1] = max(known[-1][1], start + end)
                else:
                    known.append([start + first, start + end])
        for q, known in stretches.items():
            for first, end in known:
                yield q, origin + first, origin + end


def sections(n: int, section: int) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, begin, size): what a document of ``n`` words is dealt out as."""
    octaves = (n // LEAST_POWERS).bit_length()
    shared = min(octaves, max(1, (section // TILES).bit_length()))
    groups = [(0, shared - 1)] if shared else []
    groups += [(k, k) for k in range(shared, octaves)]
    for first, last in groups:
        size = max(section, TILES << last)
        for begin in range(0, n, size):
            yield first, last, begin, size


def _cut(numbers: np.ndarray, last_octave: int, begin: int, size: int) -> tuple[int, np.ndarray]:
    """The words of a section with its margins, and where they begin."""
    origin = max(0, begin - (1 << last_octave))
    return origin, numbers[origin : begin + size + (5 << last_octave)]


def long_enough(period, words):
    return words >= max(LEAST_WORDS, LEAST_POWERS * period)


def collapse(words: list[bytes], runs: list[dict]) -> bytes:
    """The words, by single spaces, without those of a run behind its first period."""
    kept = np.ones(len(words), bool)
    for run in runs:
        kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
    return b" ".join(words) if kept.all() else b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _collapsed(text: bytes, digest: bool) -> str:
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


_EXPLODED = (
    "kind int, n_words long, text string, period long, first long, end long, "
    "first_octave int, last_octave int, origin long, begin long, size long, numbers binary"
)


class _Rows:
    """Rows for one Arrow batch, and how many bytes they hold."""

    def __init__(self, schema: pa.Schema, keep: int):
        self.schema, self.keep = schema, keep
        self.clear()

    def clear(self):
        self.source, self.rows, self.bytes = [], [], 0

    def add(self, source: int, **values):
        self.source.append(source)
        self.rows.append(values)
        self.bytes += 100 + len(values.get("text") or "") + len(values.get("numbers") or b"")

    def batch(self, kept: pa.RecordBatch) -> pa.RecordBatch:
        columns = [kept.column(i).take(pa.array(self.source, pa.int32())) for i in range(self.keep)]
        for field in list(self.schema)[self.keep :]:
            columns.append(pa.array([r.get(field.name) for r in self.rows], field.type))
        out = pa.RecordBatch.from_arrays(columns, names=self.schema.names)
        self.clear()
        return out


def _explode(batches: Iterator[pa.RecordBatch], section: int, digest: bool, types: list) -> Iterator[pa.RecordBatch]:
    """Short texts solved, long ones as sections. Texts that hold a fragment go along, others are done."""
    for batch in batches:
        keep = batch.num_columns - 1
        schema = pa.schema([batch.schema.field(i) for i in range(keep)] + types)
        rows = _Rows(schema, keep)
        for i, value in enumerate(batch.column(keep)):
            words = value.as_py().encode().split()
            n = len(words)
            numbers = word_numbers(words)
            parts = sections(n, section)
            if n > section:
                for first, last, begin, size in parts:
                    origin, cut = _cut(numbers, last, begin, size)
                    rows.add(
                        i, kind=PART, n_words=n, first_octave=first, last_octave=last, origin=origin, begin=begin, size=size,
                        numbers=cut.tobytes(),
                    )
                    if rows.bytes > BATCH_BYTES:
                        yield rows.batch(batch)
                found = True
            else:
                found = [
                    (q, first, end)
                    for part in parts
                    for q, first, end in fragments(numbers, part[0], part[1], 0, 0, part[3])
                    if long_enough(q, end - first + q)
                ]
                for q, first, end in found:
                    rows.add(i, kind=FRAGMENT, n_words=n, period=q, first=first, end=end)
            plain = b" ".join(words)
            if found:
                rows.add(i, kind=TEXT, n_words=n, text=plain.decode())
            else:
                rows.add(i, kind=PLAIN, n_words=n, text=_collapsed(plain, digest))
            if rows.bytes > BATCH_BYTES:
                yield rows.batch(batch)
        yield rows.batch(batch)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, period, start, stop = [], [], [], []
        for part in batch.to_pylist():
            numbers = np.frombuffer(part["numbers"], np.int32)
            places = (part[c] for c in ("first_octave", "last_octave", "origin", "begin", "size"))
            for q, first, end in fragments(numbers, *places):
                row.append(part["_row"])
                period.append(q)
                start.append(first)
                stop.append(end)
        columns = [pa.array(c, pa.int64()) for c in (row, period, start, stop)]
        yield pa.RecordBatch.from_arrays(columns, ["_row", "period", "first", "end"])


def _apply(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = [
            _collapsed(collapse(text.as_py().encode().split(), runs.as_py()), digest)
            for text, runs in zip(batch.column("text"), batch.column("runs"))
        ]
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def stitch(found: DataFrame) -> DataFrame:
    """(_row, start, period, length): fragments (_row, period, first, end) joined where they touch, long enough, of least period."""
    order = Window.partitionBy("_row", "period").orderBy("first", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parted = found.withColumn("_new", F.coalesce((F.col("first") > reached).cast("long"), F.lit(1)))
    parted = parted.withColumn("_stretch", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parted.groupBy("_row", "period", "_stretch").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    whole = whole.withColumn("length", F.col("end") - F.col("start") + F.col("period"))
    whole = whole.filter(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_POWERS * F.col("period")))
    return whole.groupBy("_row", "start", "length").agg(F.min("period").alias("period"))


def find_runs(
    docs: DataFrame, *, keep: list[str], text_col: str = "text", collapsed: str = "text", section: int = SECTION
) -> DataFrame:
    """(kept columns, n_words, runs, collapsed): the runs of each text, and the text without their repeats.

    ``runs``: array of (start, period, length) in words from 0, by start and period. ``collapsed``: the kept words by single spaces,
    as ``text`` or as its ``sha256``. A word is dropped if a run holds it behind the run's first period. One row per input row,
    repeated rows and missing ids included; a missing text is empty and has no runs. Columns not kept may have any name;
    kept ones may not be called n_words, runs or collapsed.
    """
    if clash := {"n_words", "runs", "collapsed"} & set(keep):
        raise ValueError(f"columns to keep clash with the result: {', '.join(sorted(clash))}")
    if section & (section - 1) or section < 2 * TILES:
        raise ValueError("section must be a power of two, 32 at least")
    digest = {"text": False, "sha256": True}[collapsed]
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), kept.alias("_kept"), text_or_empty(F.col(f"`{text_col}`")).alias("text")
    )
    exploded = T.StructType(rows.schema.fields[:2] + T._parse_datatype_string(_EXPLODED).fields)
    types = [pa.field(f.name, _arrow(f.dataType)) for f in exploded.fields[2:]]
    exploded = materialize(rows.mapInArrow(partial(_explode, section=section, digest=digest, types=types), exploded))
    parts = exploded.filter(F.col("kind") == PART)
    places = ["first_octave", "last_octave", "origin", "begin", "size"]
    parts = parts.select("_row", *places, "numbers").repartition("_row", "first_octave", "begin")
    solved = parts.mapInArrow(_solve, "_row long, period long, first long, end long")
    short = exploded.filter(F.col("kind") == FRAGMENT).select("_row", "period", "first", "end")
    runs = stitch(short.unionByName(solved)).groupBy("_row")
    runs = runs.agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    none = F.array().cast(runs.schema["runs"].dataType)
    columns = ["_kept", "n_words", "text"]
    texts = exploded.filter(F.col("kind") == TEXT).select("_row", *columns).join(runs, "_row", "left")
    texts = texts.select(*columns, F.coalesce("runs", none).alias("runs"))
    texts = texts.mapInArrow(partial(_apply, digest=digest), texts.schema)
    plain = exploded.filter(F.col("kind") == PLAIN).select(*columns, none.alias("runs"))
    done = plain.unionByName(texts)
    return done.select(*[F.col("_kept").getField(c).alias(c) for c in keep], "n_words", "runs", F.col("text").alias("collapsed"))


def _arrow(kind: T.DataType) -> pa.DataType:
    return {T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}[kind]


def repeat_tail(words: Column, first: Column, period: Column) -> Column:
    """Words of which those from place ``first`` on repeat the ``period`` words there, to the old length."""
    rest = F.size(words) - first
    copies = F.ceil(rest / period).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, first + 1, period), copies))
    return F.concat(F.slice(words, F.lit(1), first), F.slice(tail, F.lit(1), rest))
