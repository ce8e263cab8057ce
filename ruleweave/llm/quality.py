"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Measures are taken in one pass over a text; no measure compares all words with all words. A rule gives an inclusive
range for a ratio of measures; an open end is None.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import let, text_or_empty, words

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be at by this from or an "
    "der die das und in zu den mit von ist nicht ein eine für auf im dem des sich auch als "
    "le la les de des et en un une du que dans pour est par sur pas qui au avec "
    "el los las que y en un una por con no para es se al lo como del su"
).split()
SYMBOLS = "#*$%&|<>"
WINDOW = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÈÉÊËÎÏÔÛÙÁÍÓÚÑ"


@dataclass(frozen=True)
class Rule:
    name: str
    value: Column
    least: float | None = None
    most: float | None = None

    def passes(self) -> Column:
        bounds = [self.value >= self.least] if self.least is not None else []
        bounds += [self.value <= self.most] if self.most is not None else []
        return reduce(lambda a, b: a & b, bounds)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def default_rules() -> list[Rule]:
    return [
        Rule("mean_word_length", _share("word_chars", "n_words"), 2.0, 14.0),
        Rule("symbols_per_word", _share("n_symbols", "n_words"), most=0.1),
        Rule("exclamations_per_word", _share("n_exclamations", "n_words"), most=0.3),
        Rule("upper_case_share", _share("n_upper", "word_chars"), most=0.4),
        Rule("stop_word_share", _share("n_stop_words", "n_words"), least=0.04),
        Rule("duplicate_line_share", _share("n_dup_lines", "n_lines"), most=0.5),
    ]


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found at least twice; each counts once.

    The windows are sorted with their places, so equal ones are neighbours.
    """

    def marked(windows: Column) -> Column:
        def twin(window: Column, i: Column) -> Column:
            same = [F.get(windows, j)["words"] == window["words"] for j in (i - 1, i + 1)]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        places = F.transform(
            F.filter(windows, twin), lambda w: F.array(*[w["at"] + k for k in range(WINDOW)])
        )
        return F.size(F.array_distinct(F.flatten(places)))

    def window(i: Column) -> Column:
        # Words hold no space, so the joined form is unambiguous.
        return F.struct(F.concat_ws(" ", *[F.get(tokens, i + k) for k in range(WINDOW)]).alias("words"), i.alias("at"))

    starts = F.sequence(F.lit(0), F.size(tokens) - WINDOW)
    return F.when(F.size(tokens) <= WINDOW, 0).otherwise(let(F.sort_array(F.transform(starts, window)), marked))


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the counts that the rules use)."""
    text = F.col("_text")
    split = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text")).select(
        "doc_id", "_text", words(text).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )

    def removed(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")

    return split.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        removed(SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        removed("!").alias("n_exclamations"),
        removed(UPPER).alias("n_upper"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def judge(measures: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add base_failed and kept, with the names of the rules that failed in order.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. Missing texts are empty and fail.
    """
    rules = default_rules() if rules is None else rules
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules]))
    judged = measures.withColumn("base_failed", base_failed).withColumn("failed_rules", F.array_join(failed, ","))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
