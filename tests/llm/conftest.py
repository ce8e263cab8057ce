import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))

# Ids, texts and sources with nulls, ties, repeated rows, an empty and a very long text.
EDGE = [
    (1, "the cat and the dog sat on the mat by the old oak tree in the sun", "a"),
    (1, "the cat and the dog sat on the mat by the old oak tree in the sun", "a"),
    (2, "the cat and the dog sat on the mat by the old oak tree in the sun", None),
    (2, "another text under the same id", "b"),
    (3, "", "b"),
    (4, None, "b"),
    (None, "no id here", "c"),
    (None, None, None),
    (5, LONG, "c"),
    (6, "   \n\t  ", "d"),
    (7, "é" * 300 + " ünïcödé 🙂", "d"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with extra columns named as the operators' own."""
    rows = [(i, t, "en", s, len(t or ""), "x", 1, "y", 0.5, None) for i, t, s in EDGE]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, row string, key long, spans string, "
        "score double, _text string",
    )


@pytest.fixture(scope="session")
def empty(edge):
    return edge.filter("false")


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    from ruleweave.operators.stages import release

    release(spark)
