from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import comments, py_draw, rows_of, with_examples
from ruleweave.functions.text import build_prompt
from ruleweave.plans import training as tr


def example_rows(n, rule="r", start=0):
    return [
        with_examples(
            {"row_id": i, "rule": rule, "subreddit": f"s{i % 3}", "body": f"body {i}"},
            f"p1 {i}", f"p2 {i}", f"n1 {i}", f"n2 {i}",
        )
        for i in range(start, start + n)
    ]


def brute_slices(row):
    out = []
    for side, other, label in (("positive", "negative", 1), ("negative", "positive", 0)):
        for i in (1, 2):
            coin = py_draw(f"pseudo-{side}-{i}", row["row_id"]) % 2
            drawn = row[f"{other}_example_{1 + coin}"]
            sibling = row[f"{side}_example_{3 - i}"]
            pair = (sibling, drawn) if side == "positive" else (drawn, sibling)
            out.append((row["rule"], row["subreddit"], row[f"{side}_example_{i}"], *pair, label))
    return out


def test_unpivot(spark):
    rows = example_rows(20)
    got = rows_of(tr.unpivot_examples(comments(spark, rows)), *tr.PSEUDO_COLUMNS)
    assert got == sorted((s for r in rows for s in brute_slices(r)), key=repr)


def test_pseudo_set_has_no_copies(spark):
    one = example_rows(1)[0]
    rows = [{**one, "row_id": i} for i in range(40)]
    got = tr.pseudo_training_set(comments(spark, rows), frac=1.0)
    assert got.columns == tr.PSEUDO_COLUMNS
    # Two sides, two bodies each, two drawn examples of the other side.
    assert got.count() == 8


def test_pseudo_set_takes_the_sampled_rows(spark):
    rows = example_rows(60, "a") + example_rows(40, "b", 60)
    ids = lambda r: {int(x.body.split()[1]) for x in r.collect()}
    got = ids(tr.pseudo_training_set(comments(spark, rows), frac=0.1))
    expected = set()
    for group in (range(60), range(60, 100)):
        expected |= set(sorted(group, key=lambda i: (py_draw("pseudo", i), i))[: len(group) // 10])
    assert got == expected


def test_prompt_dataset(spark):
    train = [{**r, "rule_violation": r["row_id"] % 3} for r in example_rows(12)]
    got = tr.prompt_dataset(comments(spark, train, labelled=True))
    assert got.columns == ["prompt", "completion"] and got.count() == 12
    assert Counter(r.completion for r in got.collect()) == {"No": 4, "Yes": 4, None: 4}
    for row in got.collect():
        i = row.prompt.split("Comment: body ")[1].split("\n")[0]
        assert f"1) p{1 + py_draw('prompt-positive', i) % 2} {i}\n" in row.prompt
        assert f"2) n{1 + py_draw('prompt-negative', i) % 2} {i}\n" in row.prompt


def test_prompt_dataset_keeps_the_examples_of_pseudo_rows(spark):
    train = [{**r, "rule_violation": 1} for r in example_rows(5)]
    test = example_rows(30, start=100)
    got = tr.prompt_dataset(comments(spark, train, labelled=True), comments(spark, test), frac=0.2).collect()
    assert len(got) == 5 + 6 * 4
    assert not any("nan" in r.prompt for r in got)
    assert Counter(r.completion for r in got) == {"Yes": 5 + 12, "No": 12}


@pytest.mark.parametrize("n", [1, 3, 5, 6, 17, 29, 100])
def test_prompt_dataset_sample_size(spark, n):
    train = comments(spark, [{**r, "rule_violation": 1} for r in example_rows(5)], labelled=True)
    test = comments(spark, example_rows(30, start=100))
    whole = tr.prompt_dataset(train, test, frac=0.2)
    got = tr.prompt_dataset(train, test, frac=0.2, sample_size=n)
    assert got.count() == min(n, 29)
    assert got.exceptAll(whole).count() == 0
    first = tr.prompt_dataset(train, sample_size=n)
    assert first.count() == min(n, 5) and first.exceptAll(got).count() == 0


def test_missing_example_prints_nan(spark):
    df = comments(spark, [{"row_id": 1, "rule": "r", "rule_violation": 0}], labelled=True)
    prompt = tr.prompt_dataset(df).first().prompt
    assert prompt == df.select(
        build_prompt(F.lit("nan"), F.lit("r"), F.lit("nan"), F.lit("nan"), F.lit("nan"))
    ).first()[0]


def triplet_inputs(spark):
    train = [
        {"row_id": i, "rule": f"r{i % 2}", "subreddit": f"s{i % 3}", "body": f"train {i} http://x.org/a"}
        for i in range(30)
    ]
    train.append({"row_id": 90, "rule": "alone", "subreddit": "only", "body": "alone"})
    anchors = [
        {"row_id": 100 + i, "rule": f"r{i % 2}", "subreddit": f"s{i % 3}", "body": f"anchor {i} http://www.y.org/b/c/d"}
        for i in range(50)
    ]
    anchors += [
        {"row_id": 200, "rule": "alone", "subreddit": "only", "body": "skipped"},
        {"row_id": 201, "rule": "absent", "subreddit": "s0", "body": "skipped"},
        {"row_id": 202, "rule": None, "subreddit": "s0", "body": "skipped"},
    ]
    return comments(spark, anchors), comments(spark, train), {r["body"]: r for r in train}, anchors


@pytest.mark.parametrize("draws", [1, 3])
def test_triplets_keep_their_promises(spark, small_pieces, draws):
    anchors, train, by_text, rows = triplet_inputs(spark)
    got = tr.triplet_rows(anchors, train, draws_per_anchor=draws).collect()
    assert Counter((r.row_id, r.draw_no) for r in got) == Counter(
        (100 + i, k) for i in range(50) for k in range(draws)
    )
    by_id = {r["row_id"]: r for r in rows}
    for t in got:
        anchor, positive, negative = by_id[t.row_id], by_text[t.positive], by_text[t.negative]
        assert t.anchor == anchor["body"].replace("http://www.y.org/b/c/d", "<url>: (y.org/b/c)")
        assert positive["rule"] == anchor["rule"] and positive["subreddit"] != anchor["subreddit"]
        assert negative["rule"] != anchor["rule"]


def test_triplet_options(spark):
    anchors, train, _, _ = triplet_inputs(spark)
    assert tr.triplet_dataset(anchors, train).columns == ["anchor", "positive", "negative"]
    cleaned = tr.triplet_rows(anchors, train, clean_pool=True).collect()
    assert all("http" not in t.positive + t.negative for t in cleaned)
    assert tr.triplet_rows(anchors.filter("row_id < 200"), train, sample_size=7).count() == 7
    assert tr.triplet_rows(anchors.filter("row_id < 200"), train, fraction=0.5).count() == 25


def test_triplets_are_the_same_on_any_partitioning(spark, no_broadcast):
    anchors, train, _, _ = triplet_inputs(spark)
    first = rows_of(tr.triplet_rows(anchors, train))
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert rows_of(tr.triplet_rows(anchors.repartition(9), train.repartition(5))) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
