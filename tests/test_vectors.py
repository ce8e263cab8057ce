import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from ruleweave.functions import vectors as vec


def one(spark, a, b, fn):
    df = spark.createDataFrame([(a, b)], "a array<float>, b array<double>")
    return df.select(fn("a", "b")).first()[0]


def test_cosine(spark):
    assert one(spark, [3.0, 4.0], [4.0, 3.0], vec.cosine_similarity) == pytest.approx(0.96)
    assert one(spark, [0.0, 0.0], [1.0, 1.0], vec.cosine_similarity) == 0.0
    assert one(spark, None, [1.0, 1.0], vec.cosine_similarity) is None


def test_euclidean(spark):
    assert one(spark, [1.0, 2.0], [4.0, 6.0], vec.euclidean_distance) == 5.0


def test_l2_normalize(spark):
    unit = lambda a, _: vec.l2_normalize(a)
    assert one(spark, [3.0, 4.0], None, unit) == pytest.approx([0.6, 0.8])
    assert one(spark, [0.0, 0.0], None, unit) == [0.0, 0.0]
    assert one(spark, None, None, unit) is None


@pytest.mark.parametrize(
    "metric,expected", [("cosine", [1, 0, 0, 0]), ("euclidean", [0, 1, 0, 0])]
)
def test_nearest_side(spark, metric, expected):
    df = spark.createDataFrame([(0, 2.0, 1.0), (1, 1.0, 2.0), (2, 1.0, 1.0), (3, None, 1.0)], "i int, a double, b double")
    assert [r[0] for r in df.orderBy("i").select(vec.nearest_side("a", "b", metric=metric)).collect()] == expected


def test_nearest_side_rejects_other_metrics(spark):
    with pytest.raises(ValueError):
        vec.nearest_side("a", "b", metric="manhattan")


def brute_embedding(text, dim, limit=None):
    counts = [0.0] * dim
    for word in re.findall(r"[^\W_]+", text.lower())[:limit]:
        counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim] += 1
    norm = math.sqrt(sum(c * c for c in counts))
    return [c / norm if norm else 0.0 for c in counts]


@pytest.mark.parametrize("dim", [1, 7, 64, 300])
def test_hashed_embedding(spark, dim):
    texts = ["Éa b, b_b c2 Straße", "", "!!!", "one", " ".join(f"w{i % 97}" for i in range(5000))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    for limit in (None, 3):
        got = [r[0] for r in df.select(vec.hashed_embedding("t", dim, limit)).collect()]
        for text, vector in zip(texts, got):
            assert vector == pytest.approx(brute_embedding(text, dim, limit))


def test_hashed_embedding_of_null_is_null(spark):
    assert spark.range(1).select(vec.hashed_embedding(F.lit(None).cast("string"), 4)).first()[0] is None
