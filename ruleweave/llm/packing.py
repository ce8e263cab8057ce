"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Bulk-synchronous best-fit. Documents and gaps are sorted by size; in every round all documents look for their
successor, the smallest gap that holds them, larger documents first; of those that want the same gap the lower ranks
win; the gaps are updated and the next round begins. Sizes are whole numbers up to the capacity, so the sorted lists
are kept as runs of equal size and a sweep matches runs: its work is bounded by the capacity, whatever the row count,
and a size that holds a third of all rows is one run. Counting, ranking within a size and placing are done by Spark
over all rows; the ranks of a size are cut into hash buckets, so no task gets all rows of one.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.llm.common import held, text_or_empty
from ruleweave.operators.stages import materialize

CAPACITY = 1024
END_ID = 2
# Rows of one size that one task ranks.
RANK_ROWS = 50_000
# Chunks a worker remembers, about 250 bytes each; more are encoded again each time.
REMEMBERED = 200_000
REMEMBERED_CHARS = 48


class _ChunkIds(dict):
    """Token ids, as bytes, of a space and the chunk behind it."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.encode(" " + chunk), "<u4").tobytes()
        if len(self) < REMEMBERED and len(chunk) <= REMEMBERED_CHARS:
            self[chunk] = ids
        return ids


class ByteBpe:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The vocabulary file is that of the byte-level tokenizer, in its form as ranks; ``added`` are the (token, id) pairs that
    the tokenizer finds in a text before all else, the longer first. It never joins a single space to what stands before
    it, so texts without double spaces are encoded by chunks, each remembered.
    """

    def __init__(self, ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._encode = encoding.encode_ordinary
        self._chunks = _ChunkIds(self._encode)
        self._added = {token: np.array([i], "<u4").tobytes() for token, i in added}
        longer_first = sorted(self._added, key=len, reverse=True)
        self._parted = re.compile(f"({'|'.join(map(re.escape, longer_first))})") if added else None

    def ids(self, text: str) -> bytes:
        if self._parted is None:
            return self._plain(text)
        parts = self._parted.split(text)
        if len(parts) == 1:
            return self._plain(text)
        # Every second part is an added token.
        return b"".join(self._added[part] if i % 2 else self._plain(part) for i, part in enumerate(parts) if part)

    def _plain(self, text: str) -> bytes:
        if "  " in text:
            return np.array(self._encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        start = np.array(self._encode(first), "<u4").tobytes()
        return start + b"".join(map(self._chunks.__getitem__, rest))


def added_tokens(json_path: str) -> tuple[tuple[str, int], ...]:
    """The (token, id) pairs that a tokenizer file adds to its vocabulary. Ones that take spaces or words with them are refused."""
    with open(json_path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if odd := [a["content"] for a in added if a.get("lstrip") or a.get("rstrip") or a.get("single_word")]:
        raise ValueError(f"added tokens not supported: {odd}")
    return tuple((a["content"], a["id"]) for a in added)


def _cut(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str, added: tuple, capacity: int, end_id: int):
    tokenizer = held(f"packing-{ranks_path}-{pattern}-{added}", lambda: ByteBpe(ranks_path, pattern, added))
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        row, piece, start, length, crc = [], [], [], [], []
        for i, text in enumerate(batch.column(1)):
            ids = tokenizer.ids(text.as_py()) + end
            n = len(ids) // 4
            at, number = 0, 0
            size = n if n <= capacity else n % capacity or capacity
            while at < n:
                row.append(i)
                piece.append(number)
                start.append(at)
                length.append(size)
                crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                at, number, size = at + size, number + 1, capacity
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(row, pa.int32())),
                pa.array(piece, pa.int32()),
                *(pa.array(values, pa.int64()) for values in (start, length, crc)),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def token_pieces(
    docs: DataFrame,
    *,
    ranks_path: str,
    pattern: str,
    added: tuple[tuple[str, int], ...] = (),
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the tokens of each document and one end token, cut where too long.

    A document longer than the capacity is cut into pieces of the capacity, the first of which takes the remainder.
    A missing text is an empty one and gives a piece that holds the end token only. Ids may be null or repeat, and
    repeated rows give repeated pieces.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")),
        ]
    )
    cut = partial(_cut, ranks_path=ranks_path, pattern=pattern, added=added, capacity=capacity, end_id=end_id)
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(cut, schema)


class _Gaps:
    """Open sequences by free space: for each gap the runs (first sequence, count) that have it."""

    def __init__(self):
        self.runs: dict[int, list[list[int]]] = defaultdict(list)

    def add(self, gap: int, first: int, count: int) -> None:
        runs = self.runs[gap]
        if runs and runs[-1][0] + runs[-1][1] == first:
            runs[-1][1] += count
        else:
            runs.append([first, count])

    def sizes(self) -> list[int]:
        return sorted(gap for gap, runs in self.runs.items() if gap and runs)


def plan_runs(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Where the documents of each size go: rows (size, first rank, count, first sequence, offset), and the sequences used.

    ``counts`` holds how many documents have each size, all below or at the capacity. The documents of a size are told apart
    by their rank, from 0. One round is one sweep from the largest size down; a gap takes at most one document in it.
    """
    left = {size: n for size, n in counts.items() if n}
    ranks = dict.fromkeys(left, 0)
    gaps, placed, opened = _Gaps(), [], 0

    def place(size: int, n: int, first: int, gap: int) -> None:
        placed.append((size, ranks[size], n, first, capacity - gap))
        ranks[size] += n
        left[size] -= n

    # No two documents above half the capacity share a sequence.
    for size in sorted((s for s in left if 2 * s > capacity), reverse=True):
        n = left[size]
        place(size, n, opened, capacity)
        gaps.add(capacity - size, opened, n)
        opened += n
    while any(left.values()):
        free, updated, matched = gaps.sizes(), [], 0
        todo = sorted((s for s, n in left.items() if n), reverse=True)
        # Larger sizes choose first, so the gaps that a smaller size may look at are those and the ones below.
        waiting: list[int] = []
        for size in todo:
            while free and free[-1] >= size:
                waiting.append(free.pop())
            while left[size] and waiting:
                gap = waiting[-1]
                runs = gaps.runs[gap]
                while left[size] and runs:
                    first, count = runs[-1]
                    n = min(left[size], count)
                    place(size, n, first, gap)
                    updated.append((gap - size, first, n))
                    matched += n
                    if n == count:
                        runs.pop()
                    else:
                        runs[-1] = [first + n, count - n]
                if not runs:
                    waiting.pop()
        if not matched:
            size = todo[0]
            n = -(-left[size] // (capacity // size))
            gaps.add(capacity, opened, n)
            opened += n
        for gap, first, n in sorted(updated):
            gaps.add(gap, first, n)
    return np.array(placed, np.int64).reshape(-1, 5), opened


def _place(batches: Iterator[pa.RecordBatch], runs) -> Iterator[pa.RecordBatch]:
    size, first_rank, _, first_sequence, offset = runs.value
    # Sizes and ranks in one sortable number; ranks stay below 2**44 for capacities below 2**19.
    starts = (size << 44) | first_rank
    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        length, rank = (columns[c].to_numpy() for c in ("length", "_rank"))
        run = np.searchsorted(starts, (length << 44) | rank, side="right") - 1
        kept = [columns[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        sequence = pa.array(first_sequence[run] + rank - first_rank[run])
        yield pa.RecordBatch.from_arrays(
            [*kept, sequence, pa.array(offset[run])],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def best_fit_pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Add (sequence_id, offset) to pieces: their sequence and the place in it, gapless from 0.

    The pieces are stored once. Pieces that are equal in every column are interchangeable. No pieces give no rows.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = plan_runs(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))].T.copy()
    # Rows are bounded by the capacity, whatever the number of pieces: a size has one for each run of gaps that it fills.
    runs = spark.sparkContext.broadcast(plan)

    buckets = max(1, -(-max(counts.values(), default=1) // RANK_ROWS))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    pieces = pieces.withColumn("_bucket", bucket)
    cells = pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("_row", F.row_number().over(within)).join(cells, ["length", "_bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_row") - 1).alias("_rank")
    )
    schema = T.StructType(
        [*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(partial(_place, runs=runs), schema)
