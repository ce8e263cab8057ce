"""Repeated passages by a sparse enhanced suffix array over all documents.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Sorting every suffix of the corpus would
move many times its size, so the array is sparse: each window of ``length`` bytes elects one of its ``gram``-byte substrings,
its anchor, by the least hash, which depends on the window alone. Equal windows have equal anchors, so all that repeats is found
among the suffixes at anchors, about one in 80.

Anchors whose gram occurs once are dropped. The windows of an anchor lie in a short context; contexts that occur twice as a
whole are settled by counting. What is left are anchors at the ends of repeats: per gram their right contexts are
sorted, the longest common prefixes of neighbours give the tree of common-prefix intervals by a stack scan, and in each
interval the left contexts are tested: members that share enough to the left, and differ or end beyond it, form a maximal
repeat with all its occurrences. Grams with very many different contexts are settled by counting whole windows instead, in the
same way for all of them, so no task gets an unbounded group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import document_key, text_or_empty
from ruleweave.llm.shingles import stir
from ruleweave.operators.stages import discard, materialize


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 40
    # Contexts of one gram that one task compares; more are settled by counting windows.
    group: int = 40_000


# Windows handled at once; positions in a chunk stay below 2**20.
_CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(9).integers(1, 1 << 63, 256, np.uint64)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 20) - 1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Rolling:
    """Hashes of substrings of a chunk of bytes from sums of byte values times powers of a base."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _powers(_CHUNK + 4096)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of ``width`` values, by running minima from both ends of blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, _ALL)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, r: Repeats) -> tuple[np.ndarray, ...]:
    """(at, low, high, gram, context) of a text: windows starting at low..high elect the gram at ``at``.

    ``context`` is a hash of the bytes of these windows and their places around the gram.
    """
    found: list[np.ndarray] = []
    windows = len(data) - r.length + 1
    for chunk in range(0, max(windows, 0), _CHUNK):
        count = min(_CHUNK, windows - chunk)
        part = data[chunk : chunk + count + r.length - 1]
        rolling = Rolling(part)
        starts = np.arange(len(part) - r.gram + 1)
        grams = stir((rolling.sums[r.gram :] - rolling.sums[: len(starts)]) * rolling.down[: len(starts)])
        # The upper bits of a hash and then the place, so of equal hashes the leftmost is elected.
        packed = (grams & ~_LOW) | starts.astype(np.uint64)
        elected = (window_minima(packed, r.length - r.gram + 1) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], elected[1:] != elected[:-1])))
        last = np.concatenate((first[1:], [count])) - 1
        at = elected[first]
        found.append(np.stack((at + chunk, first + chunk, last + chunk, grams[at].view(np.int64))))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    at, low, high, gram = np.concatenate(found, axis=1)
    # An anchor cut by the end of a chunk is one.
    whole = np.concatenate(([True], at[1:] != at[:-1]))
    high = high[np.concatenate((np.flatnonzero(whole)[1:], [len(at)])) - 1]
    at, low, gram = at[whole], low[whole], gram[whole]
    context = np.zeros(len(at), np.uint64)
    group = low // _CHUNK
    for chunk in np.unique(group):
        mine = group == chunk
        start = int(low[mine][0])
        rolling = Rolling(data[start : int(high[mine][-1]) + r.length])
        context[mine] = rolling.of(low[mine] - start, high[mine] + r.length - start)
    context = stir(context ^ stir(((at - low) * 4096 + (high - low)).astype(np.uint64)))
    return at, low, high, gram, context.view(np.int64)


def _bytes(text) -> np.ndarray:
    return np.frombuffer(text.as_py().encode(), np.uint8)


def _scan(batches: Iterator[pa.RecordBatch], r: Repeats) -> Iterator[pa.RecordBatch]:
    names = ["doc", "hash", "at", "low", "high", "gram", "context"]
    for batch in batches:
        rows, columns, size = [], [], 0
        hashes = batch.column(1).to_numpy()

        def flush():
            row = np.concatenate(rows)
            fields = [np.concatenate(c) for c in zip(*columns)]
            doc = batch.column(0).take(pa.array(row))
            return pa.RecordBatch.from_arrays([doc, pa.array(hashes[row]), *map(pa.array, fields)], names)

        for i, text in enumerate(batch.column(2)):
            found = anchors(_bytes(text), r)
            if len(found[0]):
                rows.append(np.full(len(found[0]), i))
                columns.append(found)
                size += len(found[0])
            if size > 200_000:
                yield flush()
                rows, columns, size = [], [], 0
        if rows:
            yield flush()


def _contexts(batches: Iterator[pa.RecordBatch], r: Repeats) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text, split at the gram."""
    names = ["doc", "hash", "gram", "at", "low", "high", "copies", "left", "right"]
    for batch in batches:
        rows, fields, sides = [], [], ([], [])
        lists = [batch.column(i) for i in range(3, 8)]
        for i, text in enumerate(batch.column(2)):
            data = text.as_py().encode()
            for entry in zip(*(values[i].as_py() for values in lists)):
                _, at, low, high, _ = entry
                rows.append(i)
                fields.append(entry)
                sides[0].append(data[low:at])
                sides[1].append(data[at : high + r.length])
        index = pa.array(rows, pa.int32())
        numbers = [pa.array(values, pa.int64()) for values in (zip(*fields) if fields else [[]] * 5)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(index), batch.column(1).take(index), *numbers, *(pa.array(s, pa.binary()) for s in sides)],
            names,
        )


def common_prefixes(texts: list[bytes]) -> list[int]:
    """Lengths of the common prefixes of neighbours."""
    if len(texts) < 16:
        found = []
        for a, b in zip(texts, texts[1:]):
            n = min(len(a), len(b))
            if a[:n] == b[:n]:
                found.append(n)
                continue
            low, high = 0, n
            while high - low > 1:
                middle = (low + high) // 2
                if a[low:middle] == b[low:middle]:
                    low = middle
                else:
                    high = middle
            found.append(low)
        return found
    lengths = np.array([len(t) for t in texts])
    table = np.zeros((len(texts), int(lengths.max()) + 1), np.uint8)
    for i, t in enumerate(texts):
        table[i, : len(t)] = np.frombuffer(t, np.uint8)
    found = []
    for at in range(0, len(texts) - 1, 4096):
        part = table[at : at + 4097]
        differ = part[1:] != part[:-1]
        differ[:, -1] = True
        found.append(differ.argmax(axis=1))
    return np.minimum(np.concatenate(found), np.minimum(lengths[1:], lengths[:-1])).tolist()


def prefix_intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the tree over sorted suffixes, by one stack scan."""
    stack = [(0, 0)]
    for i, now in enumerate([*prefixes, 0], start=1):
        first = i - 1
        while stack[-1][0] > now:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if stack[-1][0] < now:
            stack.append((now, first))


def repeat_groups(left: list[bytes], right: list[bytes], length: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """(right extent, members, left extents): sets of occurrences that share a string of ``length`` around their gram.

    ``left`` are the bytes before the gram, ``right`` those from it on. Each interval of common right extent is split where
    neighbours, sorted by what stands before them, share too little; a member's left extent is the longest it shares with
    another of its set, beyond which the members differ or end.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    backward = [x[::-1] for x in left]
    for extent, first, last in prefix_intervals(common_prefixes([right[i] for i in order])):
        members = sorted(order[first : last + 1], key=backward.__getitem__)
        shared = common_prefixes([backward[i] for i in members])
        at = 0
        while at < len(shared):
            if shared[at] + extent < length:
                at += 1
                continue
            end = at
            while end < len(shared) and shared[end] + extent >= length:
                end += 1
            reach = [max(shared[max(at, i - 1) : min(end, i + 1)]) for i in range(at, end + 1)]
            yield extent, members[at : end + 1], reach
            at = end


def _ends(batches: Iterator[pa.RecordBatch], r: Repeats) -> Iterator[pa.RecordBatch]:
    """Window intervals of anchors whose context occurs once but some of whose windows repeat; rows sorted by gram."""

    def settle(rows: list[tuple]):
        left, right = [x[7] for x in rows], [x[8] for x in rows]
        for extent, members, reach in repeat_groups(left, right, r.length):
            for i, shared in zip(members, reach):
                doc, hashed, _, at, low, high, copies = rows[i][:7]
                if copies == 1:
                    yield doc, hashed, max(low, at - shared), min(high, at - r.length + extent)

    def found():
        gram, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if row[2] != gram:
                    yield from settle(rows)
                    gram, rows = row[2], []
                rows.append(row)
        yield from settle(rows)

    out = []
    for row in found():
        out.append(row)
        if len(out) == 50_000:
            yield _interval_batch(out)
            out = []
    if out:
        yield _interval_batch(out)


def _interval_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, *numbers = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.string()), *(pa.array(n, pa.int64()) for n in numbers)], ["doc", "hash", "low", "high"]
    )


def _windows(batches: Iterator[pa.RecordBatch], r: Repeats) -> Iterator[pa.RecordBatch]:
    """Every window of each context: two halves of its digest, and where it starts."""
    for batch in batches:
        doc, numbers = [], []
        for row in zip(*(batch.column(i).to_pylist() for i in range(9))):
            at, low, high, copies = row[3:7]
            data = row[7] + row[8]
            for start in range(low, high + 1):
                digest = hashlib.blake2b(data[start - low : start - low + r.length], digest_size=16).digest()
                halves = np.frombuffer(digest, "<i8").tolist()
                doc.append(row[0])
                numbers.append((row[1], *halves, start, copies))
        fields = [pa.array(n, pa.int64()) for n in (zip(*numbers) if numbers else [[]] * 5)]
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.string()), *fields], ["doc", "hash", "a", "b", "low", "copies"])


def _remove(batches: Iterator[pa.RecordBatch], r: Repeats) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, lows, highs in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            data = text.as_py().encode()
            spans: list[list[int]] = []
            for low, high in sorted(zip(lows or [], highs or [])):
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], high + r.length)
                else:
                    spans.append([low, high + r.length])
            kept, at = [], 0
            for low, high in spans:
                kept.append(data[at:low])
                at = high
            rest = b"".join([*kept, data[at:]])
            out.append((len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()))
        n_bytes, removed, n_spans, sha = zip(*out) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)), pa.array(sha, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_windows(texts: DataFrame, r: Repeats) -> DataFrame:
    """Stored (doc, hash, lows, highs) of (doc, hash, text): starts of windows that also start elsewhere, per text with any.

    ``doc`` and ``hash`` name a text; rows that agree in both are equal, and repeat each other.
    """
    numbers = "at long, low long, high long, gram long, context long"
    found = materialize(texts.mapInArrow(partial(_scan, r=r), f"doc string, hash long, {numbers}"))
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("gram")
    repeated = materialize(found.join(grams, "gram", "left_semi"))
    discard(found)
    one = F.min(F.struct("doc", "hash", "at", "low", "high"))
    cells = materialize(repeated.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("copies"), one.alias("one")))
    whole = repeated.join(cells.filter(F.col("copies") > 1).select("gram", "context"), ["gram", "context"], "left_semi")
    intervals = [materialize(whole.select("doc", "hash", "low", "high"))]
    discard(repeated)

    # Grams with several contexts, at least one of which occurs once.
    several = cells.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("least"))
    several = materialize(several.filter((F.col("n") > 1) & (F.col("least") == 1)).select("gram", "n"))
    fields = ["gram", "at", "low", "high", "copies"]
    single = cells.join(several, "gram").select("one.*", "gram", "copies")
    wanted = materialize(single.groupBy("doc", "hash").agg(F.collect_list(F.struct(*fields)).alias("w")).select("doc", "hash", *[F.col(f"w.{f}").alias(f"{f}s") for f in fields]))
    discard(cells)
    joined = texts.join(wanted, ["doc", "hash"])
    schema = "doc string, hash long, gram long, at long, low long, high long, copies long, left binary, right binary"
    contexts = joined.select("doc", "hash", "text", *[f"{f}s" for f in fields]).mapInArrow(partial(_contexts, r=r), schema)
    contexts = materialize(contexts)
    discard(wanted)
    hot = several.filter(F.col("n") > r.group).select("gram")
    if hot.isEmpty():
        few = contexts
    else:
        few = contexts.join(hot, "gram", "left_anti").select(*contexts.columns)
        many = contexts.join(hot, "gram", "left_semi").select(*contexts.columns)
        windows = materialize(many.mapInArrow(partial(_windows, r=r), "doc string, hash long, a long, b long, low long, copies long"))
        twice = windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("a", "b")
        again = windows.filter(F.col("copies") == 1).join(twice, ["a", "b"], "left_semi")
        intervals.append(materialize(again.select("doc", "hash", "low", F.col("low").alias("high"))))
        discard(windows)
    sorted_rows = few.repartition("gram").sortWithinPartitions("gram")
    intervals.append(materialize(sorted_rows.mapInArrow(partial(_ends, r=r), "doc string, hash long, low long, high long")))
    discard(contexts)
    discard(several)
    every = intervals[0]
    for more in intervals[1:]:
        every = every.unionByName(more)
    gathered = every.groupBy("doc", "hash").agg(F.collect_set(F.struct("low", "high")).alias("w"))
    stored = materialize(gathered.select("doc", "hash", F.col("w.low").alias("lows"), F.col("w.high").alias("highs")))
    for frame in intervals:
        discard(frame)
    return stored


def remove_repeats(docs: DataFrame, r: Repeats = Repeats(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): every text as UTF-8 without its repeated passages.

    A missing text counts as an empty one. Matches lie within one document each; other rows, repeated ones included, and other
    places of the same text count as elsewhere. A text shorter than ``length`` keeps all its bytes.
    """
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), document_key(id_col).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"))
    windows = repeated_windows(texts.select("doc", "hash", "text"), r)
    joined = texts.join(windows, ["doc", "hash"], "left").select("doc_id", "text", "lows", "highs")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(partial(_remove, r=r), schema)
