import pytest
from pyspark.sql import functions as F

from helpers import comments, rows_of, sha, with_examples
from ruleweave.operators import centroids as ce
from ruleweave.operators import sets as st
from ruleweave.plans import inference as inf


def vectors(spark, mapping):
    return spark.createDataFrame(
        [(sha(t), [float(x) for x in v]) for t, v in mapping.items()], "text_key string, embedding array<float>"
    )


VECTORS = {
    "bad": (1, 0), "worse": (0.8, 0.6), "good": (0, 1), "fine": (0, 0.5), "rule": (0.5, 0.5),
    "near bad": (1, 0.1), "near good": (0.1, 1), "even": (-1, 0),
}
ROW = {"rule": "rule", "subreddit": "s"}


def sample(spark):
    rows = [
        with_examples({**ROW, "row_id": 1, "body": "near bad"}, "bad", "worse", "good", "fine"),
        with_examples({**ROW, "row_id": 2, "body": "near good"}, "bad", None, "good", "good"),
        with_examples({**ROW, "row_id": 3, "body": "unknown"}, "bad", "no vector", "good", "fine"),
        with_examples({"row_id": 4, "body": "near bad", "rule": None}, "bad", "worse", "good", "fine"),
        with_examples({"row_id": 5, "body": "near bad", "rule": "empty"}, None, None, None, None),
        with_examples({"row_id": 6, "body": "even", "rule": "only bad"}, "bad", None, None, None),
        {"row_id": 7, "body": None, "rule": "rule"},
    ]
    return comments(spark, rows)


def centroid_map(spark, df, mapping=VECTORS, dim=2):
    found = ce.rule_centroids(df, vectors(spark, mapping), dim=dim).collect()
    return {r.rule_key: (r.violating_centroid, r.non_violating_centroid) for r in found}


def test_centroids(spark):
    got = centroid_map(spark, sample(spark))
    assert set(got) == {"rule", "empty", "only bad"}
    assert got["rule"][0] == pytest.approx([0.9, 0.3])
    # good, fine and the rule itself; copies of an example count once.
    assert got["rule"][1] == pytest.approx([0.5 / 3, 2 / 3])
    assert got["empty"] == ([0.0, 0.0], [0.0, 0.0])
    assert got["only bad"] == ([1.0, 0.0], [0.0, 0.0])


def test_rule_that_is_its_own_example_counts_twice(spark):
    df = comments(spark, [with_examples({**ROW, "row_id": 1}, "bad", None, "rule", "good")])
    assert centroid_map(spark, df)["rule"][1] == pytest.approx([1 / 3, 2 / 3])


def test_rules_that_clean_to_the_same_text_merge(spark):
    rows = [
        with_examples({"row_id": 1, "rule": "no http://www.a.org/x?1"}, "bad", None, "good", None),
        with_examples({"row_id": 2, "rule": "no http://a.org/x#2"}, "worse", None, "fine", None),
    ]
    got = centroid_map(spark, comments(spark, rows))
    assert list(got) == ["no <url>: (a.org/x)"]
    assert got["no <url>: (a.org/x)"][0] == pytest.approx([0.9, 0.3])


def classify(spark, metric="cosine"):
    got = inf.centroid_classify(sample(spark), vectors(spark, VECTORS), dim=2, metric=metric)
    assert got.columns == ["row_id", "rule_violation"]
    return {r.row_id: r.rule_violation for r in got.collect()}


def test_classify(spark):
    # 3: unknown text; 4: no rule; 5: both centroids zero, a tie; 6: -1 against 0; 7: no text.
    assert classify(spark) == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}


def test_classify_euclidean(spark):
    assert classify(spark, "euclidean") == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}


def test_classify_salted(spark, no_broadcast):
    assert classify(spark) == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}


def test_classify_in_pieces(spark, small_pieces):
    assert classify(spark) == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}


def test_copies_keep_their_rows(spark, small_pieces):
    hot = sample(spark).filter("row_id = 1").drop("row_id").crossJoin(spark.range(300).withColumnRenamed("id", "row_id"))
    got = inf.centroid_classify(hot, vectors(spark, VECTORS), dim=2)
    assert got.agg(F.count("*"), F.sum("rule_violation"), F.countDistinct("row_id")).first() == (300, 300, 300)


def test_one_vector_per_text(spark):
    df = spark.createDataFrame(
        [("a", 2, [2.0]), ("a", 1, [1.0]), ("b", 5, [5.0]), (None, 0, [0.0])],
        "text_key string, id int, embedding array<float>",
    )
    assert rows_of(ce.one_vector_per_text(df, key="id")) == [("a", [1.0]), ("b", [5.0])]


def test_builtin_embedder_agrees_with_its_vectors(spark):
    from ruleweave.plans.models import embed_texts

    rows = [
        with_examples(
            {"row_id": i, "rule": f"no spam {i % 2}", "body": f"{'buy' if i % 3 else 'hello'} {i % 5} http://www.shop.org/{i}"},
            f"buy {i % 3}", "sale", f"hello {i % 4}", None,
        )
        for i in range(40)
    ]
    df = comments(spark, rows)
    table = embed_texts(st.distinct_texts(df), dim=16)
    builtin = rows_of(inf.centroid_classify_builtin(df, dim=16))
    assert builtin == rows_of(inf.centroid_classify(df, table, dim=16))
    assert {label for _, label in builtin} == {0, 1}


def test_examples_are_read_once_for_centroids(spark):
    plan = ce.rule_centroids(sample(spark), vectors(spark, VECTORS), dim=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_full_inference(spark):
    replies = spark.createDataFrame(
        [(1, None), (2, "Yes"), (3, "yes"), (4, "No"), (5, "Yes"), (6, None)], "row_id long, reply string"
    )
    got = rows_of(inf.full_inference(sample(spark), replies, vectors(spark, VECTORS), dim=2))
    assert got == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 1), (6, 0), (7, 0)]


def test_distinct_texts_and_counts(spark):
    df = sample(spark)
    texts = {r.text for r in st.distinct_texts(df).collect()}
    assert texts == {"near bad", "near good", "unknown", "even", "rule", "empty", "only bad", "bad", "worse", "good",
                     "fine", "no vector"}
    counts = {r.stage: r.n_rows for r in st.stage_counts(all=df, rules=st.distinct_rules(df)).collect()}
    assert counts == {"all": 7, "rules": 4}


def test_filters(spark):
    df = sample(spark)
    assert st.filter_not_missing(df, "rule").count() == 6
    assert st.filter_rule(df, "rule").count() == 4
    known = st.filter_known_text(df, vectors(spark, VECTORS), text_col="body")
    assert [r[0] for r in rows_of(known, "row_id")] == [1, 2, 4, 5, 6]
    assert known.columns == df.columns


def test_union_with_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([("y", 2)], "only_b string, id int")
    assert rows_of(st.union_with_missing(a, b), "id", "only_a", "only_b") == [(1, "x", None), (2, None, "y")]


def test_comments_without_a_reply_keep_their_label(spark):
    rows = [{"row_id": i, "body": "same words", "rule": "r", "positive_example_1": "same words"} for i in (1, 2)]
    replies = spark.createDataFrame([(1, "No")], "row_id long, reply string")
    got = inf.full_inference(comments(spark, rows), replies, dim=8).collect()
    assert sorted(r.row_id for r in got) == [1, 2]
