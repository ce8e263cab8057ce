import pytest

from helpers import rows_of
from ruleweave.operators.joins import join_predictions
from ruleweave.plans import ensemble as en


def predictions(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"row_id long, rule_violation {kind}")


def test_join_predictions(spark):
    a = predictions(spark, [(None, 1.0), (1, 0.5), (1, 0.6), (2, 0.1)])
    b = predictions(spark, [(None, 0.0), (1, 1.0), (3, 1.0)])
    got = join_predictions(a, b)
    assert got.columns == ["row_id", "rule_violation_llm", "rule_violation_gte"]
    assert rows_of(got) == [(1, 0.5, 1.0), (1, 0.6, 1.0), (None, 1.0, 0.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_suffixes_only_shared_columns(spark):
    a = spark.createDataFrame([(1, 2, 3)], "row_id long, x int, y int")
    b = spark.createDataFrame([(1, 4, 5)], "row_id long, x int, z int")
    assert join_predictions(a, b, suffixes=("_a", "_b")).columns == ["row_id", "x_a", "y", "x_b", "z"]


@pytest.mark.parametrize(
    "weights,expected", [((0.6, 0.4), [(1, 1), (2, 0), (3, 1)]), ((0.5, 0.5), [(1, 0), (2, 0), (3, 1)]),
                         ((2.0, 1.0), [(1, 1), (2, 1), (3, 1)])]
)
def test_weighted(spark, weights, expected):
    a = predictions(spark, [(1, 1), (2, 0), (3, 1), (4, 1)], "int")
    b = predictions(spark, [(1, 0), (2, 1), (3, 1)], "int")
    assert rows_of(en.ensemble_weighted(a, b, weights=weights)) == expected


def test_binarize(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.51), (2, None), (3, float("nan")), (4, -1.0)], "i int, s double")
    assert [r[0] for r in df.orderBy("i").select(en.binarize_score("s")).collect()] == [0, 1, 0, 0, 0]


def test_override(spark):
    replies = spark.createDataFrame([(1, "Yes"), (2, "yes"), (3, None), (9, "Yes")], "row_id long, reply string")
    labels = predictions(spark, [(1, 0), (2, 0), (3, 1), (4, 1)], "int")
    assert rows_of(en.ensemble_override(replies, labels)) == [(1, 1), (2, 0), (3, 1)]
    assert rows_of(en.ensemble_override(replies, labels, positive_token="yes")) == [(1, 0), (2, 1), (3, 1)]
