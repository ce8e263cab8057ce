"""Vector expressions over ``array<float|double>`` columns. All sums run in double."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words are runs of letters and digits in any script.
WORD_PATTERN = r"[\p{L}\p{N}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, which may use it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def l2_normalize(vector: Column | str) -> Column:
    """Unit-length vector; the zero vector stays zero."""
    vector = _col(vector)
    return let(
        F.sqrt(_dot(vector, vector)),
        # try_divide gives null for a zero norm only; the entries are then zero already.
        lambda norm: F.transform(
            vector, lambda x: F.coalesce(F.try_divide(x.cast("double"), norm), F.lit(0.0))
        ),
    )


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; 0 when either is zero; null when either is missing."""
    a, b = _col(a), _col(b)
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(
        a.isNotNull() & b.isNotNull(), F.coalesce(F.try_divide(_dot(a, b), norms), F.lit(0.0))
    )


def euclidean_distance(a: Column | str, b: Column | str) -> Column:
    a, b = _col(a), _col(b)
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(_total(F.transform(gaps, lambda g: g * g)))


def nearest_side(violating: Column | str, non_violating: Column | str, *, metric: str = "cosine") -> Column:
    """1 if the violating side is strictly nearer, else 0.

    The arguments are similarities for ``cosine`` (larger is nearer) and distances for ``euclidean``.
    """
    violating, non_violating = _col(violating), _col(non_violating)
    if metric == "cosine":
        nearer = violating > non_violating
    elif metric == "euclidean":
        nearer = violating < non_violating
    else:
        raise ValueError(f"metric must be 'cosine' or 'euclidean', not {metric!r}")
    return F.when(nearer, 1).otherwise(0)


def word_bucket(word: Column, buckets: int) -> Column:
    """Hash bucket of a word: the first 32 bits of its md5, modulo."""
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def hashed_embedding(text: Column | str, dim: int = 64, max_tokens: int | None = None) -> Column:
    """Unit vector of hashed word counts, computed within the row.

    ``max_tokens`` cuts a text to its first words; by default the whole text counts.
    """
    text = _col(text)
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    if max_tokens is not None:
        words = F.slice(words, 1, max_tokens)
    buckets = F.transform(words, lambda w: word_bucket(w, dim))
    counts = let(F.sort_array(buckets), lambda ordered: _run_lengths(ordered, dim))
    return F.when(text.isNotNull(), let(counts, l2_normalize))


def _run_lengths(ordered: Column, dim: int) -> Column:
    """How often each of 0 .. dim-1 occurs in a sorted array.

    Lengths are differences of the places where runs end, so the work does not grow with length times dimension.
    """
    n = F.size(ordered)
    ends = F.filter(
        F.sequence(F.lit(0), n),
        lambda k: (k > 0) & ((k == n) | (F.get(ordered, k - 1) != F.get(ordered, k))),
    )

    def spread(ends: Column, found: Column) -> Column:
        def length(place: Column) -> Column:
            before = F.coalesce(F.get(ends, (place - 2).cast("int")), F.lit(0))
            return F.when(place > 0, F.get(ends, (place - 1).cast("int")) - before).otherwise(0).cast("double")

        return F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)), lambda bucket: let(F.array_position(found, bucket), length)
        )

    return let(
        ends, lambda e: let(F.transform(e, lambda k: F.get(ordered, k - 1)), lambda found: spread(e, found))
    )
