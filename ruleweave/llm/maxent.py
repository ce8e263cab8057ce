"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The probability of a word is that of its class given the words before it, times that of the word in its class. The words of
the head form classes of their own, in order of frequency, and there the word given its class is a softmax over the same
features: one choice among ``width`` words for the most frequent, and for the others (``head_classes``, of equal counts) one
choice after another down nested classes of ``width`` parts. Words outside the head fall into classes by their ending, in
which they have their add-one share. Features are the previous
word, the pair and single words further back (skips), hashed into rows of two weight tables.

Counts are exact and cover all training texts. Training is synchronous: in every round each task runs AdaGrad over its texts,
beginning with the shared tables, and the changes are averaged row by row, weighed by how often a task used the row. Every
training text is used in one round. Scores follow the dealing of texts to tasks: the same files and settings give the same. The most frequent words, at most ``head`` of them, are looked up in the
task; the others are joined with the counts. An unknown word counts as one further word, as in the base score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.llm.common import held, text_or_empty
from ruleweave.operators.stages import discard, materialize

# The end of a text, as a token. It holds white space, so no word is equal to it.
END = b"\n"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass(frozen=True)
class Model:
    """``word_classes`` of ``width`` frequent words each, ``ending_classes`` by the last ``ending`` bytes, and ``head_classes``.

    Without ``head_classes`` the words of the head behind the word classes fall into the ending classes.
    """

    word_classes: int = 16
    width: int = 16
    ending_classes: int = 16
    ending: int = 3
    head_classes: int = 0
    # At most 1 << 16.
    rows: int = 1 << 15
    head: int = 1 << 17
    rounds: int = 2
    rate: float = 0.15
    batch: int = 16_384
    # Tokens that a task learns from at least, if there are as many: a task hands on the rows it used, 8 MB at most.
    task_tokens: int = 1_000_000
    # Distinct words a task counts before it hands them on.
    counted: int = 300_000

    @property
    def classes(self) -> int:
        return self.word_classes + self.ending_classes + self.head_classes

    @property
    def top(self) -> int:
        return self.word_classes * self.width

    @property
    def first_head_class(self) -> int:
        return self.word_classes + self.ending_classes


# All words of the head have a softmax.
WHOLE_HEAD = Model(word_classes=8, ending_classes=8, head_classes=8, rows=1 << 16, batch=32_768)
FEATURES = 5
# Features of the nodes further down a head class: none, and the previous word.
DEEP_FEATURES = 2
_BLOCK = 1024
# Rows met this often in a batch are not worth a run of their own.
_FEW = 4
# Bytes of texts whose words are looked up together.
_CHUNK = 1 << 22
# Rows taken together at a time, so that what is computed of them stays in the cache of a core.
_PIECE = 2048
# Bytes of the longest words whose checksums are taken together.
_SHORT = 64
# Checksums of single bytes, without the inversions before and behind.
_CRC = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space with A-Z lowered, and the end."""
    return [*text.encode().translate(_LOWER).split(), END]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``tokens`` without the ends, one text after another, and their number in each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    words, lengths = lists.flatten().cast(pa.binary()), pc.list_value_length(lists).to_numpy().astype(np.int64)
    # A text without words is split into one empty word.
    empty = pc.binary_length(words).to_numpy() == 0
    if empty.any():
        lengths -= np.bincount(np.repeat(np.arange(len(lengths)), lengths)[empty], minlength=len(lengths))
        words = words.filter(pa.array(~empty))
    return words, lengths


def crc32_words(words: pa.Array, last: int | None = None) -> np.ndarray:
    """``zlib.crc32`` of each word, or of its ``last`` bytes, as columns: the words' first bytes, then their second ones, and so on."""
    _, offsets, data = words.buffers()
    found = np.zeros(len(words), np.uint64)
    if not len(words) or data is None:
        return found
    bounds = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)
    starts, sizes = bounds[:-1], np.diff(bounds)
    if last is not None:
        starts, sizes = starts + np.maximum(sizes - last, 0), np.minimum(sizes, last)
    long = np.flatnonzero(sizes > _SHORT)
    # Longer words first, so that those with a further byte are a run.
    order = np.argsort((_SHORT + 1 - np.minimum(sizes, _SHORT + 1)).astype(np.uint8), kind="stable")[len(long) :]
    starts, left = starts[order], np.cumsum(np.bincount(sizes[order], minlength=_SHORT + 1)[::-1])[::-1]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for at, n in enumerate(left[1:].tolist()):
        if not n:
            break
        now = crc[:n]
        crc[:n] = _CRC.take((now ^ data.take(starts[:n] + at)) & np.uint32(0xFF)) ^ (now >> np.uint32(8))
    found[order] = ~crc
    for i in long.tolist():
        found[i] = zlib.crc32(data[bounds[i + 1] - sizes[i] : bounds[i + 1]])
    return found


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in runs of ``_CHUNK`` bytes; a longer one is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + _CHUNK, side="right")))
        yield texts.slice(at, end - at)
        at = end


def _count(batches: Iterator[pa.RecordBatch], m: Model) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])
    parts: list[pa.Table] = []
    texts = held_rows = 0

    def added() -> pa.Table:
        every = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return pa.Table.from_arrays([every["word"], every["c_sum"]], schema=schema)

    for batch in batches:
        for chunk in _chunks(batch.column(0)):
            texts += len(chunk)
            found = split_words(chunk)[0].value_counts()
            parts.append(pa.Table.from_arrays([found.field("values"), found.field("counts")], schema=schema))
            held_rows += len(found)
            if held_rows > 2 * m.counted:
                parts = [added()]
                held_rows = parts[0].num_rows
                if held_rows > m.counted:
                    yield from parts[0].to_batches()
                    parts, held_rows = [], 0
    if texts:
        parts.append(pa.Table.from_arrays([pa.array([END]), pa.array([texts])], schema=schema))
        yield from added().to_batches()


def word_counts(texts: DataFrame, m: Model) -> DataFrame:
    """(word, c) over all texts of a one-column frame; counts are added up in the tasks first."""
    return texts.mapInArrow(partial(_count, m=m), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequency_bin(count: Column | str) -> Column:
    """Sixteen bins of counts to a doubling."""
    return F.floor(F.log2(count) * 16).cast("int")


@dataclass
class Vocabulary:
    """The head of the counts, and totals: of all tokens, and of the words of each ending class."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    class_totals: np.ndarray
    class_words: np.ndarray
    # Words of lower frequency bins are not in the head.
    least_bin: int = 0
    # Numbers at which the head classes begin, and the end of the last.
    bounds: np.ndarray | None = None

    @classmethod
    def read(cls, counts: DataFrame, m: Model) -> Vocabulary:
        whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        # As many of the highest bins as hold no more than ``head`` words; there are at most 16 bins per bit of a count.
        bins = counts.groupBy(frequency_bin("c").alias("b")).agg(F.count(F.lit(1)).alias("v")).collect()
        held, least = 0, 1 << 20
        for row in sorted(bins, key=lambda r: -r["b"]):
            held += row["v"]
            if held > m.head:
                break
            least = row["b"]
        frequent = counts.filter(frequency_bin("c") >= least).orderBy(F.col("c").desc(), "word").collect()
        words = [bytes(r["word"]) for r in frequent]
        ending = F.crc32(F.substring("word", -m.ending, m.ending)) % m.ending_classes
        rest, bounds = counts, None
        if m.head_classes:
            rest = counts.filter(frequency_bin("c") < least)
            added = np.cumsum([r["c"] for r in frequent[m.top :]], dtype=np.float64)
            shares = np.arange(1, m.head_classes) / m.head_classes
            inner = m.top + np.searchsorted(added, shares * added[-1]) if len(added) else np.full(len(shares), m.top)
            bounds = np.array([m.top, *inner, max(m.top, len(words))], np.int64)
        elif words:
            rest = counts.filter(~F.col("word").isin([bytearray(w) for w in words[: m.top]]))
        totals, kinds = np.zeros(m.ending_classes), np.zeros(m.ending_classes)
        for row in rest.groupBy(ending.alias("e")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            totals[row["e"]], kinds[row["e"]] = row["n"], row["v"]
        return cls(words, np.array([r["c"] for r in frequent], np.int64), whole["n"], whole["v"], totals, kinds, least, bounds)


class Encoder:
    """Texts as arrays: number in the head (-1 if not in it), class, slot in the class and hash of each token."""

    def __init__(self, vocabulary: Vocabulary, m: Model):
        self.m, self.v = m, vocabulary
        self.words = pa.array(vocabulary.words, pa.binary())
        self.classes = np.array(
            [i // m.width if i < m.top else self.ending(w) for i, w in enumerate(vocabulary.words)], np.int64
        )
        # The last slot is that of words outside the head.
        self.slots = np.append(np.arange(len(vocabulary.words)) % m.width, 0)
        if m.head_classes:
            behind = np.arange(m.top, len(vocabulary.words))
            part = np.searchsorted(vocabulary.bounds[1:], behind, side="right")
            self.classes[m.top :] = m.first_head_class + part
            self.slots[m.top : len(vocabulary.words)] = behind - vocabulary.bounds[part]
        self.hashes = np.array([zlib.crc32(w) for w in vocabulary.words], np.uint64)

    def ending(self, word: bytes) -> int:
        return self.m.word_classes + zlib.crc32(word[-self.m.ending :]) % self.m.ending_classes

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._encoded(pa.array(words, pa.binary()), np.arange(len(words)))[:3]

    def _encoded(self, words: pa.Array, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number, class and hash of the words in the given order, and those that are not in the head."""
        number = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)[order]
        kinds, hashed = (a[number] if len(a) else np.zeros(len(number), a.dtype) for a in (self.classes, self.hashes))
        behind = np.flatnonzero(number < 0)
        rare = words.take(pa.array(order[behind]))
        kinds[behind] = self.m.word_classes + crc32_words(rare, self.m.ending).astype(np.int64) % self.m.ending_classes
        hashed[behind] = crc32_words(rare)
        return number, kinds, hashed, rare.to_numpy(zero_copy_only=False)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Tokens of each text, and of all tokens number, class and hash, and those that are not in the head."""
        words, lengths = split_words(texts)
        sizes = lengths + 1
        # The end stands behind the words.
        order = np.full(sizes.sum(), len(words))
        order[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)] = np.arange(len(words))
        return sizes, *self._encoded(pa.concat_arrays([words, pa.array([END], pa.binary())]), order)


@cache
def _outcome_mask(width: int) -> np.ndarray:
    """Row i has ones for the first i of ``width`` outcomes."""
    return np.tri(width + 1, width, -1, np.float32)


def _per_row(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A value for each row of a table as an array of its shape; arithmetic of both is one run, without a start for each row."""
    return np.repeat(values, table.shape[1]).reshape(table.shape)


def _put(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``table[rows] = values``, a row being one item, which is copied as a whole."""
    item = f"V{table.shape[1] * table.itemsize}"
    table.view(item)[rows, 0] = values.view(item)[:, 0]


class Tables:
    """Class and word weights of a hashed log-linear model."""

    def __init__(
        self,
        m: Model,
        by_class: np.ndarray | None = None,
        by_word: np.ndarray | None = None,
        bounds: np.ndarray | None = None,
    ):
        self.m = m
        self.sizes = None if bounds is None else np.diff(bounds)
        self.by_class = np.zeros((m.rows, m.classes), np.float32) if by_class is None else by_class.copy()
        self.by_word = np.zeros((m.rows, m.width), np.float32) if by_word is None else by_word.copy()
        self.squares = [np.full(m.rows, 1e-3, np.float32) for _ in range(2)]
        self.used = [np.zeros(m.rows, np.int64) for _ in range(2)]
        # Room that is used again and again.
        self.spare = np.empty(2 * _PIECE * max(m.classes, m.width), np.float32)
        self.errors = np.empty(0, np.float32)

    @staticmethod
    def features(hashed: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Feature hashes of every token: none, previous word, previous pair, and the second and third word back."""
        padded = np.concatenate((np.zeros(3, np.uint64), hashed))
        n = len(hashed)
        back = [padded[3 - k : 3 - k + n].copy() for k in (1, 2, 3)]
        for k in (1, 2, 3):
            for j in range(k):
                edge = starts + j
                back[k - 1][edge[edge < n]] = np.uint64(0)
        rows = np.empty((FEATURES, n), np.uint64)
        rows[0] = np.uint64(1)
        rows[1] = back[0] * _MIX[0] + np.uint64(2)
        rows[2] = back[0] * _MIX[1] + back[1] * _MIX[2] + np.uint64(3)
        rows[3] = back[1] * _MIX[3] + np.uint64(4)
        rows[4] = back[2] * _MIX[2] + np.uint64(5)
        return rows

    def _rows(self, features: np.ndarray, kinds: np.ndarray | None = None) -> np.ndarray:
        mixed = features.copy() if kinds is None else features ^ ((kinds.astype(np.uint64) + np.uint64(1)) * _MIX[3])
        mixed ^= mixed >> np.uint64(31)
        mixed *= _MIX[1]
        mixed >>= np.uint64(40)
        mixed &= np.uint64(self.m.rows - 1)
        return mixed.view(np.int64)

    def _choices(self, kinds: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, ...]:
        """Choices below the classes: token, name of the choice, outcome, and number of outcomes; none for ending classes."""
        m = self.m
        word = np.flatnonzero(kinds < m.word_classes)
        found = [(word, kinds[word], slots[word], np.full(len(word), m.width))]
        deep = np.flatnonzero(kinds >= m.first_head_class)
        kind, slot = kinds[deep], slots[deep]
        # The parts of a class at a level, and of them that of the word.
        parts = self.sizes[kind - m.first_head_class] if len(deep) else deep
        level = 1
        while len(keep := np.flatnonzero(parts > 1)):
            if len(keep) < len(deep):
                deep, kind, slot, parts = deep[keep], kind[keep], slot[keep], parts[keep]
            node = slot // m.width
            before = node * m.width
            # A head class has fewer levels than 64.
            found.append((deep, kind + m.classes * (level + 64 * node), slot - before, np.minimum(m.width, parts - before)))
            slot, parts, level = node, -(-parts // m.width), level + 1
        return tuple(np.concatenate(part) for part in zip(*found))

    @staticmethod
    def _scores(
        weights: np.ndarray, rows: list[np.ndarray], out: np.ndarray | None = None, more: np.ndarray | None = None
    ) -> np.ndarray:
        """Sum of the weight rows of each feature, in ``out``; a feature with one row is the same for all. ``more`` is room."""
        scores = weights.take(rows[-1], axis=0, mode="clip", out=out)
        for k in rows[:-1]:
            every = k if len(k) == len(scores) else np.repeat(k, len(scores))
            scores += weights.take(every, axis=0, mode="clip", out=more)
        return scores

    def _pieces(
        self, which: int, rows: list[np.ndarray], outcomes: np.ndarray | None = None, into: np.ndarray | None = None
    ) -> Iterator[tuple]:
        """(piece, exponentials, sums) of all rows, piece by piece; the exponentials lie ``into``, or are overwritten by the next."""
        weights = (self.by_class, self.by_word)[which]
        room = self.spare[: 2 * _PIECE * weights.shape[1]].reshape(2 * _PIECE, -1)
        for at in range(0, len(rows[-1]), _PIECE):
            piece = slice(at, min(at + _PIECE, len(rows[-1])))
            n = piece.stop - at
            out = room[:n] if into is None else into[piece]
            scores = self._scores(weights, [k if len(k) == 1 else k[piece] for k in rows], out, room[_PIECE : _PIECE + n])
            yield piece, *self._exponentials(scores, None if outcomes is None else outcomes[piece])

    @staticmethod
    def _exponentials(scores: np.ndarray, outcomes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials of the scores of all outcomes, zero for those behind ``outcomes``, and their sums."""
        # Far above any score that training gives, far below what overflows.
        if scores.max(initial=0) > 60:
            np.minimum(scores, np.float32(60), out=scores)
        np.exp(scores, out=scores)
        if outcomes is not None and outcomes.min(initial=scores.shape[1]) < scores.shape[1]:
            scores *= _outcome_mask(scores.shape[1]).take(outcomes, axis=0, mode="clip")
        # A product with ones would round by the place of the row.
        return scores, np.einsum("ij->i", scores)

    def _class_rows(self, features: np.ndarray) -> list[np.ndarray]:
        rows = self._rows(features[1:])
        return [self._rows(features[:1, :1])[0], *rows]

    def _word_steps(self, kinds: np.ndarray, slots: np.ndarray, features: np.ndarray) -> Iterator[tuple]:
        """(token, chosen, outcomes, rows): the choices below the classes, by the number of features that tell them.

        The first choice in a class has all features. The nodes further down a head class, each of which is seldom met, are told
        by themselves and the previous word.
        """
        word, names, chosen, outcomes = self._choices(kinds, slots)
        # Names of nodes behind the first of their level begin here; see ``_choices``.
        deep = names >= 64 * self.m.classes
        for part, used in ((np.flatnonzero(~deep), FEATURES), (np.flatnonzero(deep), DEEP_FEATURES)):
            if len(part):
                told = word[part]
                yield told, chosen[part], outcomes[part], list(self._rows(features[:used].take(told, axis=1), names[part]))

    def log_probabilities(self, kinds: np.ndarray, slots: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural log of class, and of word in class where it is a word or head class, for each token."""
        found = self._logs(0, self._class_rows(features), kinds)
        for word, chosen, outcomes, rows in self._word_steps(kinds, slots, features):
            found += np.bincount(word, self._logs(1, rows, chosen, outcomes), len(kinds))
        return found

    def _logs(self, which: int, rows: list[np.ndarray], target: np.ndarray, outcomes: np.ndarray | None = None) -> np.ndarray:
        found = np.empty(len(target))
        for piece, raised, total in self._pieces(which, rows, outcomes):
            chosen = np.arange(0, raised.size, raised.shape[1]) + target[piece]
            found[piece] = np.log((raised.reshape(-1).take(chosen) / total).astype(np.float64))
        return found

    def _step(self, which: int, rows: list[np.ndarray], target: np.ndarray, outcomes: np.ndarray | None = None) -> None:
        width = (self.by_class, self.by_word)[which].shape[1]
        if len(self.errors) < len(target) * width:
            self.errors = np.empty(len(target) * width, np.float32)
        errors = self.errors[: len(target) * width]
        error = errors.reshape(-1, width)
        chosen = np.arange(0, len(errors), width) + target
        for piece, raised, total in self._pieces(which, rows, outcomes, error):
            raised /= _per_row(total, raised)
            errors[chosen[piece]] -= 1
        for k in rows:
            if len(k) == 1:
                self._update(which, k, error.sum(axis=0, keepdims=True), len(target))
                continue
            # Rows fit into 16 bits, which are sorted by counting.
            short = k.astype(np.uint16)
            order = np.argsort(short, kind="stable")
            ordered = short.take(order)
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            times = np.diff(np.append(first, len(order)))
            # Those met most often come first, so that in a piece the ones with a further change are a run.
            ranked = np.argsort((_FEW + 1 - np.minimum(times, _FEW + 1)).astype(np.uint8), kind="stable")
            first, times = first[ranked], times[ranked]
            touched = ordered[first].astype(np.int64)
            many = int(np.count_nonzero(times > _FEW))
            change = self._added_runs(error, order, first[:many], times[:many])
            for at in range(0, many, _PIECE):
                piece = slice(at, min(at + _PIECE, many))
                self._update(which, touched[piece], change[piece], times[piece])
            for at in range(many, len(first), _PIECE):
                piece = slice(at, at + _PIECE)
                change = self._added(error, order, first[piece], times[piece])
                self._update(which, touched[piece], change, times[piece])

    def _added(self, error: np.ndarray, order: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Errors of rows that are met a few times, one by one; ``times`` falls, and row i has those from ``first[i]`` of ``order`` on."""
        out = self.spare[: 2 * _PIECE * error.shape[1]].reshape(2 * _PIECE, -1)
        change = error.take(order.take(first), axis=0, mode="clip", out=out[: len(first)])
        for more in range(1, _FEW):
            again = int(np.count_nonzero(times > more))
            if not again:
                break
            change[:again] += error.take(order.take(first[:again] + more), axis=0, mode="clip", out=out[_PIECE : _PIECE + again])
        return change

    @staticmethod
    def _added_runs(error: np.ndarray, order: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Errors of rows that are met often."""
        change = np.empty((len(first), error.shape[1]), np.float32)
        ends = np.cumsum(times)
        at = 0
        while at < len(first):
            before = ends[at] - times[at]
            end = max(at + 1, int(np.searchsorted(ends, before + _PIECE, side="right")))
            piece = slice(at, end)
            starts = ends[piece] - times[piece] - before
            inside = order.take(np.arange(ends[end - 1] - before) + np.repeat(first[piece] - starts, times[piece]))
            np.add.reduceat(error.take(inside, axis=0), starts, axis=0, out=change[piece])
            at = end
        return change

    def _update(self, which: int, touched: np.ndarray, change: np.ndarray, times) -> None:
        """An AdaGrad step for the given rows."""
        squares = self.squares[which].take(touched)
        squares += np.einsum("ij,ij->i", change, change) / change.shape[1]
        self.squares[which][touched] = squares
        change *= _per_row(self.m.rate / np.sqrt(squares), change)
        weights = (self.by_class, self.by_word)[which]
        room = self.spare[_PIECE * change.shape[1] : 2 * _PIECE * change.shape[1]].reshape(_PIECE, -1)
        now = weights.take(touched, axis=0, mode="clip", out=room[: len(touched)])
        now -= change
        _put(weights, touched, now)
        self.used[which][touched] += times

    def learn(self, kinds: np.ndarray, slots: np.ndarray, features: np.ndarray) -> None:
        self._step(0, self._class_rows(features), kinds)
        for _, chosen, outcomes, rows in self._word_steps(kinds, slots, features):
            self._step(1, rows, chosen, outcomes)


@dataclass
class Shared:
    """What tasks need: a broadcast (vocabulary, class weights, word weights), and a name of the vocabulary."""

    name: str
    broadcast: object

    def encoder(self, m: Model) -> Encoder:
        return held(f"maxent-{self.name}-{m}", lambda: Encoder(self.broadcast.value[0], m))


def _token_batches(columns: Iterator[pa.Array], encoder: Encoder, size: int) -> Iterator[tuple]:
    """(rare, starts, number, kinds, slots, features) of texts taken together until they have ``size`` tokens."""
    rest = None
    for column in columns:
        for chunk in _chunks(column):
            every = encoder.encode_texts(chunk)
            if rest is not None:
                every = tuple(map(np.concatenate, zip(rest, every)))
            sizes, number, _, _, rare = every
            ends = np.cumsum(sizes)
            behind = np.cumsum(number < 0)
            text = token = known = 0
            while (last := int(np.searchsorted(ends, token + size))) < len(ends):
                end = int(ends[last])
                unknown = int(behind[end - 1])
                yield _batch(encoder, sizes[text : last + 1], *(a[token:end] for a in every[1:4]), rare[known:unknown])
                text, token, known = last + 1, end, unknown
            rest = (sizes[text:], *(a[token:] for a in every[1:4]), rare[known:])
    if rest is not None and len(rest[0]):
        yield _batch(encoder, *rest)


def _batch(encoder: Encoder, sizes: np.ndarray, number: np.ndarray, kinds: np.ndarray, hashed: np.ndarray, rare: np.ndarray) -> tuple:
    starts = np.cumsum(sizes) - sizes
    return rare, starts, number, kinds, encoder.slots[number], Tables.features(hashed, starts)


def _learn(batches: Iterator[pa.RecordBatch], shared: Shared, m: Model) -> Iterator[pa.RecordBatch]:
    """One round over the texts of a task: changes of the used rows by blocks, and how often each was used."""
    encoder = shared.encoder(m)
    before = shared.broadcast.value[1:]
    tables = Tables(m, *before, encoder.v.bounds)
    texts = (batch.column(0) for batch in batches)
    for _, _, _, kinds, slots, features in _token_batches(texts, encoder, m.batch):
        # Long texts come in one piece; steps stay small.
        for at in range(0, len(kinds), m.batch):
            part = slice(at, at + m.batch)
            tables.learn(kinds[part], slots[part], features[:, part])
    for which, (old, new) in enumerate(zip(before, (tables.by_class, tables.by_word))):
        used = tables.used[which]
        blocks = [b for b in range(0, m.rows, _BLOCK) if used[b : b + _BLOCK].any()]
        if not blocks:
            continue
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([which * m.rows + b for b in blocks], pa.int64()),
                pa.array([used[b : b + _BLOCK].astype("<u4").tobytes() for b in blocks], pa.binary()),
                pa.array([(new - old)[b : b + _BLOCK].astype("<f2").tobytes() for b in blocks], pa.binary()),
            ],
            ["block", "used", "change"],
        )


def _average(batches: Iterator[pa.RecordBatch], widths: tuple[int, int], rows: int) -> Iterator[pa.RecordBatch]:
    """Changes of each block averaged over the tasks, weighed by use; one block after another is added up."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, used, change in zip(*(batch.column(i).to_pylist() for i in range(3))):
            used = np.frombuffer(used, "<u4").astype(np.float64)
            change = np.frombuffer(change, "<f2").astype(np.float64).reshape(len(used), widths[block // rows])
            total = sums.setdefault(block, [np.zeros(len(used)), np.zeros(change.shape)])
            total[0] += used
            total[1] += used[:, None] * change
    for block, (used, change) in sums.items():
        mean = (change / np.maximum(used, 1)[:, None]).astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([mean.tobytes()], pa.binary())], ["block", "change"])


def train(texts: DataFrame, fold: Column, vocabulary: Vocabulary, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Class and word weights after a round for each value of ``fold``, which splits the texts; both are of fixed size."""
    spark = texts.sparkSession
    tables = Tables(m)
    weights = [tables.by_class, tables.by_word]
    for turn in range(m.rounds):
        shared = Shared(_name(vocabulary), spark.sparkContext.broadcast((vocabulary, *weights)))
        # Few tasks for few tokens, whatever the number of files.
        part = texts.filter(fold == turn).select("text").coalesce(max(1, -(-vocabulary.total // (m.rounds * m.task_tokens))))
        changes = part.mapInArrow(partial(_learn, shared=shared, m=m), "block long, used binary, change binary")
        averaged = changes.repartition("block").mapInArrow(
            partial(_average, widths=(m.classes, m.width), rows=m.rows), "block long, change binary"
        )
        for row in averaged.collect():
            table = weights[row["block"] // m.rows]
            at = row["block"] % m.rows
            change = np.frombuffer(row["change"], "<f4").reshape(-1, table.shape[1])
            table[at : at + len(change)] += change
        shared.broadcast.destroy()
    return weights[0], weights[1]


def _name(vocabulary: Vocabulary) -> str:
    return f"{vocabulary.total}-{vocabulary.distinct}-{zlib.crc32(b' '.join(vocabulary.words))}"


def _counted_by_text(words: np.ndarray, text: np.ndarray, texts: int) -> tuple[pa.Array, pa.Array]:
    """The different words of each of ``texts`` texts and how often it holds them, as lists; ``text`` is that of each word."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    kinds = len(coded.dictionary)
    pairs, times = np.unique(text * kinds + coded.indices.to_numpy(), return_counts=True)
    ends = pa.array(np.searchsorted(pairs, np.arange(texts + 1) * kinds), pa.int32())
    different = coded.dictionary.take(pa.array(pairs % max(kinds, 1)))
    return pa.ListArray.from_arrays(ends, different), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))


def _score(batches: Iterator[pa.RecordBatch], shared: Shared, m: Model) -> Iterator[pa.RecordBatch]:
    encoder = shared.encoder(m)
    v = encoder.v
    tables = Tables(m, *shared.broadcast.value[1:], v.bounds)
    log_count = np.append(np.log10(v.counts + 1.0), 0.0)
    base_log = np.log10(v.total + v.distinct + 1.0)
    class_log = np.append(np.zeros(m.word_classes), np.log10(v.class_totals + v.class_words + 1.0))
    class_log = np.append(class_log, np.zeros(m.head_classes))
    # A head word in an ending class has its add-one share of it.
    softmax = len(v.words) if m.head_classes else m.top
    head_share = np.append(np.where(np.arange(len(v.words)) < softmax, 0.0, log_count[:-1]), 0.0)
    for batch in batches:
        at = 0
        for rare, starts, number, kinds, slots, features in _token_batches(iter([batch.column(3)]), encoder, m.batch):
            token = np.concatenate(
                [
                    tables.log_probabilities(kinds[i : i + m.batch], slots[i : i + m.batch], features[:, i : i + m.batch])
                    for i in range(0, len(kinds), m.batch)
                ]
            ) / np.log(10)
            token += head_share[number] - class_log[kinds]
            ends = np.append(starts[1:], len(number))
            score = np.add.reduceat(token, starts)
            known = np.add.reduceat((number >= 0).astype(np.int64), starts)
            base = np.add.reduceat(log_count[number] - base_log, starts)
            n = len(starts)
            lists, times = _counted_by_text(rare, np.repeat(np.arange(n), ends - starts)[number < 0], n)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i).slice(at, n) for i in range(3)),
                    pa.array(ends - starts),
                    pa.array(known),
                    pa.array(base),
                    pa.array(score),
                    lists,
                    times,
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "times"],
            )
            at += n


def score_texts(
    docs: DataFrame,
    held_out: Column,
    m: Model = WHOLE_HEAD,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text.

    The model learns from the rows for which ``held_out`` is false; a null there counts as false. ``base_score`` is the
    log10 probability by add-one counts of single words, ``score`` that of the model. Missing texts count as empty and have
    one token, the end. Ids may be null or repeat. Without training texts all words are unknown.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_or_empty(text_col).alias("text")
    )
    training = rows.filter(~F.col("held_out")).select("text")
    counts = materialize(word_counts(training, m))
    vocabulary = Vocabulary.read(counts, m)
    fold = F.pmod(F.xxhash64("text"), F.lit(m.rounds))
    weights = train(training, fold, vocabulary, m)
    shared = Shared(_name(vocabulary), spark.sparkContext.broadcast((vocabulary, *weights)))
    # Row numbers are made in the task that also writes all that belongs to them.
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score")),
            T.StructField("rare", T.ArrayType(T.BinaryType())),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )
    scored = materialize(numbered.mapInArrow(partial(_score, shared=shared, m=m), schema))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")
    )
    tail = counts.filter(frequency_bin("c") < vocabulary.least_bin)
    found = rare.join(tail, "word").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("log_count")
    )
    found = materialize(found)
    discard(counts)
    more = F.coalesce("log_count", F.lit(0.0))
    return scored.drop("rare", "times").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
