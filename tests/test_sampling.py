from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import py_draw
from ruleweave.operators import sampling as sa


def frame(spark, sizes):
    rows, i = [], 0
    for rule, n in sizes.items():
        for _ in range(n):
            rows.append((i, rule, f"text {i}"))
            i += 1
    return spark.createDataFrame(rows, "row_id long, rule string, body string")


def brute_sample(sizes, frac, tag="pseudo"):
    kept, i = set(), 0
    for rule, n in sizes.items():
        ids = range(i, i + n)
        i += n
        if rule is not None:
            kept |= set(sorted(ids, key=lambda r: (py_draw(tag, r), r))[: round(frac * n)])
    return kept


SIZES = {"a": 10, "b": 30, "c": 50, "hot": 1700, None: 40}


@pytest.mark.parametrize("bits", [0, 3, 12])
@pytest.mark.parametrize("frac", [0.0, 0.05, 0.5, 1.0])
def test_stratified_sample(spark, frac, bits):
    got = sa.stratified_sample(frame(spark, SIZES), frac=frac, bits=bits).collect()
    assert {r.row_id for r in got} == brute_sample(SIZES, frac)
    assert len(got) == len({r.row_id for r in got})


def test_stratified_sizes_round_half_to_even(spark):
    counts = Counter(r.rule for r in sa.stratified_sample(frame(spark, SIZES)).collect())
    assert counts == {"b": 2, "c": 2, "hot": 85}


def test_stratified_sample_salted(spark, no_broadcast):
    got = sa.stratified_sample(frame(spark, SIZES)).collect()
    assert {r.row_id for r in got} == brute_sample(SIZES, 0.05)


@pytest.mark.parametrize("partitions", ["1", "200"])
def test_samples_do_not_depend_on_partitioning(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sa.stratified_sample(frame(spark, SIZES).repartition(int(partitions))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.row_id for r in got} == brute_sample(SIZES, 0.05)


@pytest.mark.parametrize("n", [1, 7, 500, 1830, 5000])
def test_sample_n(spark, n):
    df = frame(spark, SIZES)
    expected = sorted(range(1830), key=lambda r: (py_draw("subsample", r), r))[:n]
    assert sorted(r.row_id for r in sa.sample_n(df, n).collect()) == sorted(expected)
    assert sa.sample_n(df, n).columns == df.columns


def test_sample_fraction(spark):
    assert sa.sample_fraction(frame(spark, {"a": 30}), 0.05).count() == 2


@pytest.mark.parametrize("n", [None, 0])
def test_head_without_limit(spark, n):
    assert sa.head_n(frame(spark, {"a": 12}), n).count() == 12


def test_head(spark, monkeypatch):
    df = spark.range(0, 400000, 37).withColumnRenamed("id", "row_id")
    expected = list(range(0, 5000 * 37, 37))
    assert sorted(r.row_id for r in sa.head_n(df, 5000).collect()) == expected
    monkeypatch.setattr(sa, "HEAD_ROWS", 10)
    assert sorted(r.row_id for r in sa.head_n(df, 5000).collect()) == expected
    assert sa.head_n(df, 10**9).count() == df.count()


def test_shuffle_batches(spark):
    got = sa.shuffle_batches(frame(spark, {"a": 100}), id_cols=["row_id"], batch_size=32).collect()
    order = sorted(range(100), key=lambda r: (py_draw("batches", r), r))
    assert {(r.row_id, r.batch_id, r.batch_pos) for r in got} == {(r, i // 32, i % 32) for i, r in enumerate(order)}
    assert Counter(r.batch_id for r in got) == {0: 32, 1: 32, 2: 32, 3: 4}


@pytest.mark.parametrize("n,batches,warmup", [(0, 0, 0), (1, 1, 0), (320, 10, 1), (321, 11, 1), (6400, 200, 20)])
def test_batch_plan(spark, n, batches, warmup):
    assert tuple(sa.batch_plan(spark.range(n)).first()) == (n, batches, warmup)


def test_no_window_sees_a_whole_stratum(spark):
    """Only the rows of the boundary bucket are moved and ranked."""
    df = spark.range(20000).select(F.col("id").alias("row_id"), F.lit("hot").alias("rule"))
    plan = sa.stratified_sample(df)
    assert plan.count() == 1000
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window") <= 2 and "(_bucket" in text


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("ids", [[None, 1, 2, 3, 4], ["b", "a", None, "c", "a"], [7, 7, 7, 7, 7], [None] * 5])
@pytest.mark.parametrize("n", [1, 3, 5, 9])
def test_head_of_any_ids(spark, monkeypatch, ids, n, small):
    if small:
        monkeypatch.setattr(sa, "HEAD_ROWS", 1)
    kind = "string" if "b" in ids else "long"
    df = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], f"row_id {kind}, other int")
    expected = sorted(ids, key=lambda x: (x is None, x or 0))[:n]
    got = [r.row_id for r in sa.head_n(df, n).collect()]
    assert sorted(got, key=lambda x: (x is None, x or 0)) == expected


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6])
def test_sample_sizes_with_null_and_repeated_ids(spark, n):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "d"), (2, "d"), (2, "e")], "row_id long, body string")
    rows = sa.sample_n(df, n).collect()
    assert len(rows) == n and Counter(map(tuple, rows)) <= Counter(map(tuple, df.collect()))
    assert sorted(map(repr, rows)) == sorted(map(repr, sa.sample_n(df.repartition(3), n).collect()))


def test_samplers_join_without_nested_loops(spark):
    df = frame(spark, SIZES)
    for sample in (sa.sample_n(df, 50), sa.sample_fraction(df, 0.1), sa.stratified_sample(df), sa.head_n(df, 50)):
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 10, 62, 101, 1000, 4001])
def test_permuted_is_a_bijection(spark, n):
    from ruleweave.functions.draws import permuted

    places = spark.range(n).select(*[permuted(F.col("id"), F.lit(n), "t", F.lit(e)).alias(f"e{e}") for e in range(3)]).collect()
    for e in range(3):
        assert sorted(r[e] for r in places) == list(range(n))
    if n > 50:
        orders = {tuple(r[e] for r in places) for e in range(3)}
        assert len(orders) == 3 and sum(r[0] == i for i, r in enumerate(places)) < n // 4


def test_epochs_are_permutations(spark):
    from ruleweave.operators.sampling import shuffle_batches

    df = spark.range(103).selectExpr("id", "1 as _draw", "2 as _ix", "3 as _bucket", "4 as _epoch")
    out = shuffle_batches(df, id_cols=["id"], batch_size=10, epochs=4)
    assert out.columns == [*df.columns, "epoch", "batch_id", "batch_pos"]
    orders = {}
    for r in out.collect():
        assert (r["_draw"], r["_ix"], r["_bucket"], r["_epoch"]) == (1, 2, 3, 4)
        orders.setdefault(r["epoch"], {})[r["batch_id"] * 10 + r["batch_pos"]] = r["id"]
    assert sorted(orders) == [0, 1, 2, 3]
    for places in orders.values():
        assert sorted(places) == list(range(103)) == sorted(places.values())
    assert len({tuple(p[i] for i in range(103)) for p in orders.values()}) == 4
    plain = {r["batch_id"] * 10 + r["batch_pos"]: r["id"] for r in shuffle_batches(df, id_cols=["id"], batch_size=10).collect()}
    assert plain == orders[0], "the first epoch has the order without epochs"
