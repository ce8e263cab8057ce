"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its n-grams, taken over the bytes of its characters, a bag the mean of its words, and a softmax over the bag
gives two classes, so an unseen misspelling shares vectors with what it is made from. A bag is a window of words: a
text is as toxic as its most toxic window, in training as in scoring, so a few words in a long text are not averaged
away. The text alone is scored; no other column is read.

A run of bytes without white space that is longer than ``word_bytes`` becomes several words that overlap, so that each of
its n-grams lies whole in one of them.

The model is fitted in one task on a bounded sample of labelled texts and is of fixed size. All texts are scored whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.functions.draws import draw
from ruleweave.llm.common import held, text_or_empty
from ruleweave.llm.shingles import stir
from ruleweave.operators.stages import materialize

# Words a worker remembers the value of.
REMEMBERED = 100_000
# Words whose n-grams are taken at once.
_PART = 20_000


@dataclass(frozen=True)
class Settings:
    """``per_class`` and ``sample_chars`` bound the sample: that many texts of each label, none longer."""

    per_class: int = 5_000
    sample_chars: int = 20_000
    buckets: int = 1 << 18
    dim: int = 8
    window: int = 2
    shortest: int = 4
    longest: int = 8
    # Longer words are split into pieces, more than ``longest - 1`` long: as long as words are, so that what is in
    # the middle weighs as much as a word.
    word_bytes: int = 48
    piece_bytes: int = 12
    epochs: int = 8
    batch: int = 64
    rate: float = 0.5
    seed: int = 11
    threshold: float = 0.7


_PLACES = np.random.default_rng(21).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def text_words(text: str, s: Settings) -> list[str | bytes]:
    """Words between white space, lowered; those longer than ``word_bytes`` with their marks as pieces of their bytes."""
    words = text.lower().split()
    # No character has more than four bytes.
    short = (s.word_bytes - 2) // 4
    if not any(len(w) > short for w in words):
        return words
    found: list[str | bytes] = []
    for w in words:
        if len(w) > short and len(marked := _marked(w)) > s.word_bytes:
            common = s.longest - 1
            found.extend(marked[i : i + s.piece_bytes] for i in range(0, len(marked) - common, s.piece_bytes - common))
        else:
            found.append(w)
    return found


def _marked(word: str | bytes) -> bytes:
    """Bytes of a word between marks; pieces of long words have the marks they were cut with."""
    return word if isinstance(word, bytes) else f"<{word}>".encode()


def word_grams(words: list[str | bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of the marked words and of the words themselves, word by word, and their numbers."""
    marked = [_marked(w) for w in words]
    data = np.frombuffer(b"".join(marked) + bytes(s.longest), np.uint8).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(m) for m in marked], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(marked)), lengths)
    total = int(ends[-1]) if len(ends) else 0
    found, owners = [], []
    rest = ends[owner] - np.arange(total)
    for n in range(s.shortest, s.longest + 1):
        fits = rest >= n
        mixed = np.full(total, n, np.uint64)
        for i in range(n):
            mixed += data[i : i + total] * _PLACES[i]
        found.append(stir(mixed[fits]))
        owners.append(owner[fits])
    if total:
        places = _PLACES[np.minimum(np.arange(total) - starts[owner], len(_PLACES) - 1)]
        found.append(stir(np.add.reduceat(data[:total] * places, starts)))
        owners.append(np.arange(len(marked)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    buckets = (np.concatenate(found)[order] & np.uint64(s.buckets - 1)).astype(np.int32)
    return buckets, np.bincount(owners, minlength=len(marked))


def window_means(values: np.ndarray, window: int) -> np.ndarray:
    """Means of all runs of ``window`` values, or of all values if there are fewer."""
    sums = np.concatenate(([0.0], np.cumsum(values)))
    width = min(window, len(values))
    return (sums[width:] - sums[:-width]) / width


class _Bags:
    """Texts as word numbers, and words as n-gram buckets, in flat arrays."""

    def __init__(self, texts: list[str], s: Settings):
        numbers: dict[str | bytes, int] = {}
        self.texts = [
            np.fromiter((numbers.setdefault(w, len(numbers)) for w in text_words(t, s)), np.int32) for t in texts
        ]
        grams, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        words = list(numbers)
        for at in range(0, len(words), _PART):
            for found, part in zip((grams, counts), word_grams(words[at : at + _PART], s)):
                found.append(part)
        self.grams = np.concatenate(grams)
        self.ends = np.concatenate(([0], np.cumsum(np.concatenate(counts))))

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the given words one after another, and the lengths of their runs."""
        lengths = self.ends[words + 1] - self.ends[words]
        starts = np.repeat(self.ends[words] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        return self.grams[starts + np.arange(lengths.sum())], lengths


def fit(texts: list[str], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Value of each bucket and the intercept: the difference of the two classes' scores.

    Embeddings and softmax weights are trained together by AdaGrad. In each text the window with the highest score takes the
    gradient. With no texts, or one label only, every text scores the share of label 1 (one half without texts).
    """
    rng = np.random.default_rng(s.seed)
    if len(set(labels.tolist())) < 2:
        rate = labels.mean() if len(labels) else 0.5
        return np.zeros(s.buckets), float(np.clip(np.log((rate + 1e-3) / (1 - rate + 1e-3)), -5, 5))
    bags = _Bags(texts, s)
    embed = rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32)
    weights = rng.normal(0, 0.5, (s.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    embed_sq = np.full(s.buckets, 1e-4, np.float32)
    weight_sq, bias_sq = np.full_like(weights, 1e-2), np.full_like(bias, 1e-2)
    # Both labels count the same as a whole.
    share = labels.mean()
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    order = np.array([i for i, t in enumerate(bags.texts) if len(t)])
    for _ in range(s.epochs):
        rng.shuffle(order)
        for at in range(0, len(order), s.batch):
            chosen = order[at : at + s.batch]
            flat = np.concatenate([bags.texts[i] for i in chosen])
            unique, back = np.unique(flat, return_inverse=True)
            grams, lengths = bags.of(unique)
            runs = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            vectors = np.add.reduceat(embed[grams], runs, axis=0) / lengths[:, None]
            value = vectors @ (weights[:, 1] - weights[:, 0])
            best, start = [], 0
            for i in chosen:
                n = len(bags.texts[i])
                width = min(s.window, n)
                first = start + int(np.argmax(window_means(value[back[start : start + n]], s.window)))
                best.append((first, width))
                start += n
            widths = np.array([w for _, w in best])
            places = np.concatenate([np.arange(f, f + w) for f, w in best])
            of_text = np.repeat(np.arange(len(best)), widths)
            bag = np.zeros((len(best), s.dim), np.float32)
            np.add.at(bag, of_text, vectors[back[places]])
            bag /= widths[:, None]
            logits = bag @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(best)), labels[chosen]] -= 1
            error = p * balance[chosen][:, None]
            grad_w, grad_b = bag.T @ error / len(best), error.mean(0)
            word_grad = (error @ weights.T / widths[:, None])[of_text]
            grams, lengths = bags.of(flat[places])
            gram_grad = np.repeat(word_grad / lengths[:, None], lengths, axis=0)
            touched, back = np.unique(grams, return_inverse=True)
            total = np.zeros((len(touched), s.dim), np.float32)
            np.add.at(total, back, gram_grad)
            embed_sq[touched] += (total**2).mean(1)
            embed[touched] -= s.rate * total / np.sqrt(embed_sq[touched])[:, None]
            weight_sq += grad_w**2
            bias_sq += grad_b**2
            weights -= 0.1 * grad_w / np.sqrt(weight_sq)
            bias -= 0.1 * grad_b / np.sqrt(bias_sq)
    return (embed @ (weights[:, 1] - weights[:, 0])).astype(np.float64), float(bias[1] - bias[0])


class Scorer:
    """Scores of texts; the values of words are kept from one batch of texts to the next."""

    def __init__(self, values: np.ndarray, intercept: float, s: Settings):
        self.values, self.intercept, self.settings = values, intercept, s
        self.words: dict[str | bytes, float] = {}

    def learn_words(self, words: list[str | bytes]) -> None:
        for at in range(0, len(words), _PART):
            part = words[at : at + _PART]
            grams, counts = word_grams(part, self.settings)
            starts = np.cumsum(counts) - counts
            self.words.update(zip(part, (np.add.reduceat(self.values[grams], starts) / counts).tolist()))

    def scores(self, texts: list[str]) -> list[float]:
        """Probability of label 1 of each text; one without words scores by the intercept alone."""
        split = [text_words(t, self.settings) for t in texts]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        self.learn_words(list({w for words in split for w in words if w not in self.words}))
        return [self._score(words) for words in split]

    def _score(self, words: list[str | bytes]) -> float:
        value = 0.0
        if words:
            found = np.fromiter(map(self.words.__getitem__, words), np.float64, len(words))
            value = window_means(found, self.settings.window).max()
        return float(1 / (1 + np.exp(-np.clip(value + self.intercept, -40, 40))))


def sample_rows(texts: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """At most ``per_class`` texts of each label that are no longer than ``sample_chars``, by lowest draw of the id.

    ``texts`` has (_id, text), ``labels`` (_id, label). The ids are drawn from the labels, so of the texts only those of
    the sample move. Of the rows of a repeated id the first by text count.
    """

    def lowest(rows: DataFrame, then: str) -> DataFrame:
        parts = [rows.filter(F.col("label") == c).orderBy("_draw", then).limit(s.per_class) for c in (0, 1)]
        return parts[0].unionByName(parts[1])

    usable = labels.filter(F.col("label").isin(0, 1) & F.col("_id").isNotNull()).select("_id", F.col("label").cast("int").alias("label"))
    chosen = lowest(usable.distinct().withColumn("_draw", draw("toxicity", "_id", seed=s.seed)), "_id")
    # Twice ``per_class`` rows at most.
    found = materialize(texts.join(F.broadcast(chosen), "_id").filter(F.length("text") <= s.sample_chars))
    return lowest(found.select("text", "label", "_draw"), "text")


def _fit_group(rows: pd.DataFrame, s: Settings) -> pd.DataFrame:
    rows = rows.sort_values(["_draw", "text"])
    values, intercept = fit(rows["text"].tolist(), rows["label"].to_numpy(np.int64), s)
    return pd.DataFrame({"values": [values.astype("<f8").tobytes()], "intercept": [intercept]})


def fit_model(texts: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of (_id, text) rows with (_id, label). The model has ``buckets`` numbers and an intercept."""
    sample = sample_rows(texts, labels, s).withColumn("_all", F.lit(0))

    def fit_all(rows: pd.DataFrame) -> pd.DataFrame:
        return _fit_group(rows, s)

    model = sample.groupBy("_all").applyInPandas(fit_all, "values binary, intercept double").first()
    if model is None:
        return fit([], np.zeros(0, np.int64), s)
    return np.frombuffer(model["values"], "<f8"), model["intercept"]


def score_texts(
    docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), *, text_col: str = "text", keep: list[str]
) -> DataFrame:
    """The kept columns, the score (0 to 1) and predicted (1 from ``threshold`` up) of every row's whole text.

    Missing texts count as empty. Kept columns named score or predicted are refused. Only the texts go to the Python workers.
    """
    if clash := {"score", "predicted"} & set(keep):
        raise ValueError(f"columns to keep clash with the result: {', '.join(sorted(clash))}")
    spark = docs.sparkSession
    crc = zlib.crc32(model[0].tobytes(), zlib.crc32(np.float64(model[1]).tobytes()))
    name, shared = f"toxicity-{crc}-{s}", spark.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = held(name, lambda: Scorer(*shared.value, s))
        for texts in columns:
            parts = (texts.slice(at, 200).to_pylist() for at in range(0, len(texts), 200))
            yield pa.array([x for part in parts for x in scorer.scores(part)], pa.float64())

    # Named nondeterministic, so that a filter on the score does not score again.
    scorer = F.arrow_udf(score, T.DoubleType()).asNondeterministic()
    scored = docs.select(*[F.col(f"`{c}`") for c in keep], scorer(text_or_empty(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= s.threshold).cast("int"))
