"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.operators.stages import measured_bytes

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return. Words are what lies between.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_or_empty(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text without nulls, in order."""
    trimmed = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN, -1))


def crc32_text(key: Column | str) -> Column:
    """crc32 of the key as text; a missing key counts as an empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def crc_fold(key: Column | str, modulus: int) -> Column:
    """``crc32_text`` modulo a number."""
    return crc32_text(key) % modulus


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body refers to it."""
    return F.transform(F.array(value), body)[0]


_HELD: dict[str, object] = {}


def held(name: str, build):
    """What a worker keeps between its tasks: the state of one operator at a time, so that those of a long job do not add up."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = build()
    return _HELD[name]


# Bytes up to which the smaller side of ``checked_join`` is broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def checked_join(left: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a wide frame with a stored one that holds a key once; the stored one is broadcast if its measured size allows.

    The keys are documents, so neither side can have a hot key but for repeated rows, which the planner splits.
    """
    if measured_bytes(side) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return left.join(side, on, how)


def document_key(id_col: Column | str) -> Column:
    """The id as a text that is never null."""
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.concat(F.lit("i"), id_col.cast("string")), F.lit("n"))
