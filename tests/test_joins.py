"""Joins with hot keys, bucketed tables, and counts taken on the way."""

import pytest
from pyspark.sql import functions as F

from helpers import ancestors, comments, rows_of, sha, with_examples
from ruleweave.operators import sets as st
from ruleweave.operators import stages
from ruleweave.operators.joins import join_predictions
from ruleweave.plans import inference as inf
from ruleweave.plans import models as mo
from ruleweave.plans import training as tr


def predictions(spark, n, nulls, seed):
    """A third of the keys are missing, some occur several times."""
    key = F.when(F.col("id") % nulls != 0, (F.col("id") * seed) % (n // 2))
    return spark.range(n).select(key.alias("row_id"), (F.col("id") % 2).cast("int").alias("rule_violation"))


@pytest.mark.parametrize("pairs", [1, 50, 900, 10**7])
def test_pair_join_is_the_plain_join(spark, pairs):
    left, right = predictions(spark, 120, 3, 7), predictions(spark, 90, 3, 11).withColumnRenamed("row_id", "other")
    got = stages.pair_join(left.withColumnRenamed("rule_violation", "a"), right, "row_id", "other", pairs=pairs)
    plain = left.withColumnRenamed("rule_violation", "a").join(right, F.col("row_id").eqNullSafe(F.col("other")))
    assert got.columns == plain.columns and rows_of(got) == rows_of(plain)


@pytest.mark.parametrize("rows, columns", [(400, 1), (1, 400), (60, 60)])
def test_pair_join_of_lopsided_keys(spark, rows, columns):
    left = spark.range(rows).select(F.lit("k").alias("a"), "id")
    right = spark.range(columns).select(F.lit("k").alias("b"), F.col("id").alias("other"))
    got = stages.pair_join(left, right, "a", "b", pairs=25)
    assert got.count() == rows * columns == got.distinct().count()


def test_missing_keys_of_both_sides_spread(spark, fixed_plans, monkeypatch):
    monkeypatch.setattr(stages, "PAIRS_PER_CELL", 400)
    joined = join_predictions(predictions(spark, 900, 3, 7), predictions(spark, 900, 3, 11))
    sizes = joined.filter("row_id is null").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 300 * 300
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 60_000


def test_hot_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    assert rows_of(stages.hot_keys(df, ["k"], 300)) == [("hot", 334), (None, 333)]
    assert stages.hot_keys(df, ["k"], 400) is None and stages.hot_keys(df.filter("false"), ["k"], 0) is None


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("limit", [-1, 1 << 20])
def test_skew_join_of_hot_rows(spark, how, limit, monkeypatch):
    monkeypatch.setattr(stages, "BROADCAST_LIMIT", limit)
    left = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    right = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    right = right.union(spark.createDataFrame([("hot", -1), (None, -2)], "k string, v long"))
    if how == "left_semi":
        right = right.select("k")
    got = stages.skew_join(left, right, ["k"], how, spread_by="id", rows_per_piece=50)
    plain = left.join(right, ["k"], how)
    assert rows_of(got.select(*plain.columns)) == rows_of(plain)


def vectors(spark, n=40):
    rows = [(sha(f"text {i}"), [float(i % 3), float(i % 5), 1.0]) for i in range(n)]
    return spark.createDataFrame(rows, "text_key string, embedding array<float>")


def sample(spark):
    rows = [
        with_examples({"row_id": i, "rule": f"text {i % 4}", "body": f"text {i % 50}"}, f"text {i % 7}", "text 9", f"text {i % 11}", None)
        for i in range(80)
    ]
    return comments(spark, rows)


def test_a_bucketed_table_is_stored_once(spark):
    table = stages.store_bucketed(vectors(spark), "text_key", buckets=4)
    assert rows_of(table) == rows_of(vectors(spark)) and table.schema == vectors(spark).schema
    stages.release(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ruleweave_")]


@pytest.mark.parametrize("size", [10**6, 1])
def test_classifying_does_not_shuffle_the_vectors(spark, fixed_plans, monkeypatch, size):
    """Neither use of them, with hot texts and without."""
    monkeypatch.setattr(stages, "ROWS_PER_PIECE", size)
    labels = inf.centroid_classify(sample(spark), vectors(spark), dim=3)
    above = ancestors(labels, "Bucketed: true")
    assert above and not [line for lines in above for line in lines if "Exchange" in line]
    members = inf.centroid_members(sample(spark)).join(stages.store_bucketed(vectors(spark), "text_key"), "text_key", "left")
    assert not [line for lines in ancestors(members, "Bucketed: true") for line in lines if "Exchange" in line]
    assert labels.count() == 80


def test_triplet_loss_does_not_shuffle_the_vectors(spark, fixed_plans):
    triplets = spark.range(30).selectExpr("id", "'text 1' as anchor", "concat('text ', id) as positive", "'text 2' as negative")
    loss = mo.triplet_margin_loss(triplets, vectors(spark), id_cols=["id"])
    above = ancestors(loss, "Bucketed: true")
    assert above and not [line for lines in above for line in lines if "Exchange" in line]
    assert loss.first()["n_triplets"] == 30


@pytest.mark.parametrize("size", [10**6, 5])
def test_known_texts_move_without_their_text(spark, fixed_plans, monkeypatch, size):
    monkeypatch.setattr(stages, "ROWS_PER_PIECE", size)
    df = spark.range(90).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "text 1").otherwise(F.concat(F.lit("text "), "id")).alias("body"))
    known = st.filter_known_text(df, vectors(spark), text_col="body", keep=["row_id"])
    plain = {i for i in range(90) if i % 3 == 0 or i < 40}
    assert known.columns == ["row_id"] and {r[0] for r in known.collect()} == plain
    assert "body" not in [line for line in known._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert rows_of(st.filter_known_text(df, vectors(spark), text_col="body")) == rows_of(df.join(known, "row_id", "left_semi"))


def labelled(spark):
    rows = [
        {**with_examples({"row_id": i, "rule": f"rule {i % 3}", "subreddit": f"s{i % 4}", "body": f"body {i % 30}"}, f"p{i}", f"q{i}", f"m{i}", f"n{i}"),
         "rule_violation": i % 2 if i < 60 else None}
        for i in range(200)
    ]
    return comments(spark, rows, labelled=True)


def test_stage_counts_come_from_the_run_itself(spark):
    read = spark.sparkContext.accumulator(0)
    source = labelled(spark)

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counts = st.StageCounts()
    tables = tr.training_tables(source.mapInArrow(passed, source.schema), counts, draws_per_anchor=2)
    got = {r["stage"]: r["n_rows"] for r in counts.frame(spark).collect()}
    assert read.value == 200, "the source is read once"
    train, test = source.filter("rule_violation is not null"), source.filter("rule_violation is null").drop("rule_violation")
    assert got == {
        "loaded": 200, "train": 60, "sampled": got["sampled"], "pseudo": tr.pseudo_training_set(test).count(),
        "total": tr.prompt_dataset(train, test).count(), "triplets": tr.triplet_rows(test, train, draws_per_anchor=2).count(),
        "distinct_texts": 30,
    }
    assert got["sampled"] * 4 >= got["pseudo"] > 0 and got["total"] == 60 + got["pseudo"]
    assert {k: tables[k].count() for k in ("prompts", "triplets", "texts")} == {
        "prompts": got["total"], "triplets": got["triplets"], "texts": 30,
    }


def exchanges(df):
    return [line.split("Exchange ")[1] for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]


def odd_labelled(spark):
    """Rows that come twice, and missing ids, texts, rules and examples."""
    rows = labelled(spark)
    for c, n in (("row_id", 41), ("body", 13), ("rule", 17), ("positive_example_1", 11), ("negative_example_2", 7)):
        rows = rows.withColumn(c, F.when(F.col("row_id") % n != 0, F.col(c)))
    return rows.union(rows.filter("row_id < 90"))


def test_texts_stay_at_home(spark, fixed_plans):
    rows = odd_labelled(spark)
    stored = stages.store_in_place(rows.repartition(3), 4)
    assert rows_of(stored.select(*rows.columns)) == rows_of(rows)
    assert stored.select(stages.HOME, stages.PLACE).distinct().count() == rows.count()
    assert stored.select(stages.HOME).distinct().count() == 3
    train, test = (stored.filter(f"rule_violation is {s} null") for s in ("not", ""))
    plain_train, plain_test = (rows.filter(f"rule_violation is {s} null") for s in ("not", ""))
    with stages._setting(spark, stages.ALL_KEYS, "false"):
        got = st.distinct_texts(stored, ["body", "rule"], homes=4)
        assert rows_of(got) == rows_of(st.distinct_texts(rows, ["body", "rule"]))
        # Digests are dealt, and then places; no table with texts.
        assert len(exchanges(got)) == 2 and all(e.startswith(("hashpartitioning(_digest", "hashpartitioning(_home")) for e in exchanges(got))
        got = tr.pseudo_training_set(test.drop("rule_violation", stages.HOME, stages.PLACE), frac=0.5, homes=4)
        assert rows_of(got) == rows_of(tr.pseudo_training_set(plain_test.drop("rule_violation"), frac=0.5)) and len(exchanges(got)) == 2
        got = tr.triplet_rows(test, train, draws_per_anchor=2, homes=4)
        assert rows_of(got) == rows_of(tr.triplet_rows(plain_test, plain_train, draws_per_anchor=2))
        # Picks meet the pool's texts by id; then they go to the anchors.
        assert [e for e in exchanges(got) if not e.startswith("hashpartitioning(pool_id")] == [e for e in exchanges(got) if ", 4), REPARTITION" in e]


def test_training_tables_are_those_of_plain_frames(spark):
    rows = odd_labelled(spark)
    train, test = rows.filter("rule_violation is not null"), rows.filter("rule_violation is null").drop("rule_violation")
    got = tr.training_tables(rows)
    assert rows_of(got["prompts"]) == rows_of(tr.prompt_dataset(train, test))
    assert rows_of(got["triplets"]) == rows_of(tr.triplet_rows(test, train))
    assert rows_of(got["texts"]) == rows_of(st.distinct_texts(rows, ["body"]))
    assert {k: v.count() for k, v in tr.training_tables(rows.limit(0)).items()} == {"prompts": 0, "triplets": 0, "texts": 0}


def test_a_stage_is_counted_once(spark):
    counts = st.StageCounts()
    counts("a", spark.range(3)).count()
    counts.add("b", 4)
    with pytest.raises(ValueError):
        counts("a", spark.range(3))
    assert rows_of(counts.frame(spark)) == [("a", 3), ("b", 4)] and counts["a"] == 3
