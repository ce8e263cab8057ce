"""Document fingerprints by MinHash, their edited texts, and near duplicates by signature bands.

A signature holds, for each of a number of universal hash functions over 5-word shingles, the least value. Values are
cut to 16 bits in a fingerprint. Near duplicates meet in a band of their signatures, and those that meet are compared by the exact
Jaccard similarity of their shingles.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm import jaccard
from ruleweave.llm.common import text_or_empty
from ruleweave.llm.shingles import WORDS, WordHashes, hashes, shingle_hashes, stir, text_words, word_table
from ruleweave.operators.stages import materialize

PERMUTATIONS = 64
# Bands of 4 values: of pairs with similarity 0.8 all but one in 5,000 meet in one.
BAND_ROWS = 4
# Documents in one range of ids at most, about; ranges to a shuffle partition at least; ids drawn per range to find its ends.
RANGE_ROWS = 50_000
RANGES_PER_PARTITION = 4
DRAWN_PER_RANGE = 20

class Signer:
    """Signatures: (a x + b) mod 2**64, of which the upper half counts, with odd a, over the shingle hashes x."""

    def __init__(self, permutations: int = PERMUTATIONS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, permutations, np.uint64)
        self.empty = np.full(permutations, np.iinfo(np.uint32).max, np.uint32)

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        """Signature of a set of shingles; that of the union of two sets is the smaller of both in each place."""
        least = self.empty.copy()
        # Only the lower half is multiplied, so the upper half of the product is a universal hash of it.
        low = shingles & np.uint64(0xFFFFFFFF)
        for at in range(0, len(low), 2048):
            values = self.a[:, None] * low[None, at : at + 2048] + self.b[:, None]
            least = np.minimum(least, (values.min(axis=1) >> np.uint64(32)).astype(np.uint32))
        return least


def fingerprint(signature: np.ndarray) -> str:
    """16 bits of each value, in hexadecimal."""
    return (signature & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the places in which two signatures agree in their 16 bits."""
    return float(np.mean((a & np.uint32(0xFFFF)) == (b & np.uint32(0xFFFF))))


class _Document:
    """A text with its signature, and that of its unchanged front after an edit."""

    def __init__(self, doc_id, text: str, signer: Signer, table: WordHashes):
        self.doc_id, self.text, self.table, self.signer = doc_id, text, table, signer
        self.words = hashes(text_words(text), table)
        shingles = shingle_hashes(self.words)
        self.cut = len(text) - len(text) // 4
        front = text[: self.cut]
        # The word at the cut may go on behind it, so the front ends before it.
        self.whole_words = max(0, len(text_words(front)) - 1)
        self.front_shingles = max(0, self.whole_words - WORDS + 1)
        self.front = signer.sign(shingles[: self.front_shingles])
        self.signature = np.minimum(self.front, signer.sign(shingles[self.front_shingles :]))

    def edited(self, successor: str) -> tuple[str, np.ndarray]:
        text = self.text[: self.cut] + successor[: len(self.text) // 4]
        words = np.concatenate([self.words[: self.whole_words], hashes(text_words(text)[self.whole_words :], self.table)])
        if len(words) < WORDS or not self.front_shingles:
            return text, self.signer.sign(shingle_hashes(words))
        return text, np.minimum(self.front, self.signer.sign(shingle_hashes(words[self.front_shingles :])))


COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _chain(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (_range, id, text); the last row of a range is a copy of its successor's first, marked as such."""
    signer, table, held = Signer(), word_table(), None
    for batch in batches:
        ids, out = [], []
        ranges, borrowed = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            text = batch.column(3)[i].as_py()
            now = (ranges[i], _Document(batch.column(2).slice(i, 1), text, signer, table))
            if held is not None and held[0] == ranges[i]:
                before, after = held[1], now[1]
                edited, signature = before.edited(after.text)
                ids.append(before.doc_id)
                out.append(
                    (
                        len(before.text),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        fingerprint(before.signature),
                        fingerprint(signature),
                        likeness(before.signature, signature),
                        likeness(before.signature, after.signature),
                    )
                )
            held = None if borrowed[i] else now
        if ids:
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *columns], names)


def fingerprint_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Fingerprints of every text and of its edit, in which the last quarter is replaced by the front of the next text.

    The next text is that of the next id; equal ids go by a hash of the text, null ids come last, and the first row follows
    the last. A missing text is an empty one: it has no shingles, is like other empty texts and unlike all others. A
    single row follows itself.

    Rows are cut into ranges of ids by ends drawn from the ids, so a text moves once, to the task of its range; only the
    first row of a range also goes to the range before it.
    """
    spark = docs.sparkSession
    null, hashed = F.col("_id").isNull(), F.xxhash64("_text")
    keyed = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    keyed = keyed.select(null.alias("_null"), "_id", hashed.alias("_hash"), "_text")
    key = ["_null", "_id", "_hash"]
    facts = keyed.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*key)).alias("first")).first()
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, {COLUMNS}"
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    ranges = max(RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-facts["n"] // range_rows))
    # About DRAWN_PER_RANGE keys per range, from which every so-manieth is an end.
    drawn = keyed.select(*key).sample(fraction=min(1.0, DRAWN_PER_RANGE * ranges / facts["n"]), seed=7).collect()
    drawn = sorted({tuple(r) for r in drawn})
    ends = sorted({tuple(facts["first"]), *drawn[DRAWN_PER_RANGE :: DRAWN_PER_RANGE]})

    @F.pandas_udf("int")
    def place(null: pd.Series, ids: pd.Series, hashed: pd.Series) -> pd.Series:
        """Twice the range, plus one for its first row."""
        found = []
        for row in zip(null, ids, hashed):
            row = (row[0], None, row[2]) if row[0] else row
            at = bisect_right(ends, row) - 1
            found.append(2 * at + (ends[at] == row))
        return pd.Series(found, dtype="int32")

    placed = keyed.withColumn("_place", place(*key))
    at = F.shiftright("_place", 1)
    own = F.struct(at.alias("range"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.pmod(at - 1, F.lit(len(ends))).cast("int").alias("range"), F.lit(True).alias("borrowed"))
    copies = F.when(F.col("_place") % 2 == 1, F.array(own, lent)).otherwise(F.array(own))
    rows = placed.select(F.explode(copies).alias("_to"), *key, "_text").select("_to.*", *key, "_text")
    rows = rows.repartition("range").sortWithinPartitions("range", "borrowed", *key)
    names = [field.split()[0] for field in schema.split(", ")]
    return rows.select("range", "borrowed", "_id", "_text").mapInArrow(partial(_chain, names=names), schema)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    signer = Signer()
    for batch in batches:
        keys, bands = [], []
        for text in batch.column(2):
            shingles = jaccard.shingle_set(text.as_py())
            keys.append(jaccard.set_key(shingles))
            values = signer.sign(shingles).astype(np.uint64).reshape(-1, BAND_ROWS)
            total = np.arange(len(values), dtype=np.uint64)
            for i in range(BAND_ROWS):
                total = stir(total * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
            bands.append(total.view(np.int64) if len(shingles) else [])
        columns = [pa.array(keys, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_hash", "key", "paths"])


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = jaccard.SIMILARITY,
    count_links: bool = True,
) -> DataFrame:
    """(doc_id, text_hash, class_key, class_id, n_links) by signature bands; see ``jaccard.classes`` for the columns."""
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    scanned = materialize(texts.mapInArrow(_bands, f"doc_id {kind}, text_hash long, key long, paths array<long>"))
    sets = jaccard.stored_sets(scanned, ["paths"])
    members = materialize(sets.select(F.explode("paths").alias("bucket"), "key"))
    sizes = materialize(jaccard.bucket_sizes(members))
    large = sizes.filter(F.col("n") > jaccard.SMALL)
    inside = members.join(large.select("bucket"), "bucket")
    units = [materialize(jaccard.small_units(members, sizes)), materialize(jaccard.parts_of(inside, large))]
    return jaccard.classes(
        docs, scanned, sets, units, similarity=similarity, id_col=id_col, text_col=text_col, count_links=count_links
    )
