"""Personal data: patterns propose spans, checksums confirm them, words before a span adjust its score.

Built-in expressions only. The places of matches come from the lengths of the matches and of the text between them,
so a text is scanned a fixed number of times per kind, however many matches it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import let, text_or_empty

ACCEPTED = 0.5
CONTEXT_CHARS = 40
_BLOCK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _digit_count(match: Column) -> Column:
    return F.length(_digits(match))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""

    def check(d: Column) -> Column:
        def term(total: Column, i: Column) -> Column:
            digit = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
            return total + F.when(i % 2 == 1, doubled).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), term) % 10 == 0

    return let(digits, check)


def mod_97(code: Column) -> Column:
    """Whether an account number, letters and digits only, leaves 1 modulo 97 by the rule of ISO 7064."""

    def check(s: Column) -> Column:
        def step(rest: Column, i: Column) -> Column:
            char = F.ascii(F.substring(s, i + 1, F.lit(1)))
            return F.when(char < 65, (rest * 10 + char - 48) % 97).otherwise((rest * 100 + char - 55) % 97).cast("int")

        return F.aggregate(F.sequence(F.lit(0), F.length(s) - 1), F.lit(0), step) == 1

    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))
    return let(turned, check)


@dataclass(frozen=True)
class Kind:
    """``valid`` must hold; the score is ``score``, plus ``boost`` if a context word stands before the match."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    boost: float = 0.0
    context: str = ""


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Possessive repeats match the same text as plain ones here, as what follows them cannot begin inside; they neither
# backtrack nor recurse. A local part is tried once per run of its characters, or right behind the previous match.
BASE_KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        1.0,
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.9),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda m: F.length(m).between(13, 37) & _digit_count(m).between(13, 19) & luhn(_digits(m)),
        0.9,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _digit_count(m).between(9, 15), 0.8),
)
MORE_KINDS = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        lambda m: mod_97(F.translate(m, " ", "")),
        0.9,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.3,
        0.4,
        r"(?:ssn|social security|sozialvers|numéro de sécu|seguridad social)",
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+-]{20,}(?![A-Za-z0-9_/+-])",
        lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"),
        0.2,
        0.5,
        r"(?:token|secret|password|passwd|api.?key|credential)",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+.()-])\(?0?[0-9]{2,5}\)?[\x20/.-][0-9]{3,5}(?:[\x20.-][0-9]{2,5}){0,2}(?![0-9.-])",
        lambda m: _digit_count(m).between(7, 13),
        0.2,
        0.4,
        r"(?:phone|tel[.: ]|telefon|téléphone|teléfono|mobile|call |fax)",
    ),
)


def running_sums(values: Column) -> Column:
    """Sums of all elements up to each one. Appending in blocks keeps the copies short for long arrays."""

    def append(acc: Column, x: Column) -> Column:
        total = acc["total"] + x
        return F.struct(F.concat(acc["sums"], F.array(total)).alias("sums"), total.alias("total"))

    def start(total: Column) -> Column:
        return F.struct(F.array().cast("array<int>").alias("sums"), total.cast("int").alias("total"))

    def summed(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int"))

        def block(b: Column) -> Column:
            return F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))

        totals = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda a, x: a + x))
        ends = F.aggregate(totals, start(F.lit(0)), append, lambda acc: acc["sums"])

        def inside(offsets: Column) -> Column:
            def sums(b: Column) -> Column:
                before = F.coalesce(F.get(offsets, b - 1), F.lit(0))
                return F.aggregate(block(b), start(before), append, lambda acc: acc["sums"])

            return F.flatten(F.transform(blocks, sums))

        return let(ends, inside)

    return let(values, summed)


def _spans(text: Column, matches: Column, kind: Kind) -> Column:
    """The accepted matches of a kind as structs (start, end, score), in order; starts count code points."""

    def placed(gaps: Column) -> Column:
        steps = F.transform(
            matches,
            lambda _, i: F.length(F.get(gaps, i)) + F.coalesce(F.length(F.get(matches, i - 1)), F.lit(0)),
        )

        def entry(at: Column, i: Column) -> Column:
            match = F.get(matches, i)
            score = F.lit(kind.score)
            if kind.context:
                before = F.lower(F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)))
                score = score + F.when(before.rlike(kind.context), kind.boost).otherwise(0.0)
            score = F.when(kind.valid(match), score).otherwise(0.0)
            return F.struct(at.alias("start"), (at + F.length(match)).alias("end"), score.alias("score"))

        found = F.transform(running_sums(steps), entry)
        return F.filter(found, lambda span: span["score"] >= ACCEPTED)

    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    return F.when(F.size(matches) == 0, none).otherwise(let(F.split(text, kind.pattern, -1), placed))


def find_spans(
    docs: DataFrame, *, text_col: str = "text", kinds: tuple[Kind, ...] = BASE_KINDS + MORE_KINDS
) -> DataFrame:
    """Per document (row, spans): ``row`` is the input row as a struct, ``spans`` a struct with an array per kind.

    Matches of a kind do not overlap; those of different kinds may. A missing text counts as an empty one.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    matched = docs.select(row, text_or_empty(text_col).alias("_text")).select(
        "row",
        "_text",
        *[F.regexp_extract_all("_text", F.lit(kind.pattern), 0).alias(f"_{kind.name}") for kind in kinds],
    )
    spans = [_spans(F.col("_text"), F.col(f"_{kind.name}"), kind).alias(kind.name) for kind in kinds]
    return matched.select("row", "_text", *spans).select(
        "row", F.col("_text").alias("text"), F.struct(*[kind.name for kind in kinds]).alias("spans")
    )


def span_list(kinds: tuple[Kind, ...]) -> Column:
    """kind:start:end of all spans by kind as listed, then start, joined by commas."""

    def listed(kind: Kind) -> Column:
        def entry(span: Column) -> Column:
            places = [span["start"].cast("string"), span["end"].cast("string")]
            return F.concat_ws(":", F.lit(kind.name), *places)

        return F.transform(f"spans.{kind.name}", entry)

    parts = [listed(kind) for kind in kinds]
    return F.array_join(F.concat(*parts), ",")


def mask(text: Column, kinds: tuple[Kind, ...] = BASE_KINDS + MORE_KINDS) -> Column:
    """The text with every span replaced by its kind in angle brackets; where spans overlap the first one, of equal starts the longest, names it."""

    def tagged_spans(kind: Kind) -> Column:
        tag = F.lit(f"<{kind.name.upper()}>").alias("tag")
        return F.transform(f"spans.{kind.name}", lambda span: F.struct(span["start"], (-span["end"]).alias("back"), tag))

    tagged = F.concat(*[tagged_spans(kind) for kind in kinds])

    def cut(acc: Column, span: Column) -> Column:
        fresh = span["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, span["start"] - acc["at"]), span["tag"])
        return F.struct(
            F.when(fresh, F.concat(acc["pieces"], F.array(piece))).otherwise(acc["pieces"]).alias("pieces"),
            F.greatest(acc["at"], -span["back"]).alias("at"),
        )

    start = F.struct(F.array().cast("array<string>").alias("pieces"), F.lit(0).alias("at"))
    masked = F.aggregate(
        F.sort_array(tagged),
        start,
        cut,
        lambda acc: F.concat(F.array_join(acc["pieces"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(tagged) == 0, text).otherwise(masked)
