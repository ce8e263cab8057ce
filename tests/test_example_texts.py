"""How the texts of worked examples travel: to the comments, into distinct rows, into files."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from ruleweave.catalog import queries
from ruleweave.operators import stages
from ruleweave.operators.sets import distinct_rows
from ruleweave.plans import training as tr
from ruleweave.sources import files as fi
from ruleweave.sources import tables as tb


@pytest.fixture
def folder(spark, tmp_path):
    """Ids with gaps and a missing one, rows that come twice, a missing language, and one whose examples are of one side only."""
    docs = [(i * 3 if i % 50 else i, f"text {i % 120}" if i % 17 else None, ["en", "de", "fr", None][min(i % 7, 3)], f"s{i % 4}") for i in range(400)]
    docs += docs[:20] + [(None, "no id", "en", "s0")]
    labels = [(d[0], int(d[2] != "fr" and d[0] % 5 == 0), 1) for d in docs[:400] if d[0] % 2 == 0]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def brute_comments(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    pool = {}
    for d in sorted((d for d in docs if d["doc_id"] in toxic and d["lang"] is not None), key=lambda d: d["doc_id"]):
        pool.setdefault((d["lang"], toxic[d["doc_id"]]), []).append(d["text"])

    def example(d, side, i):
        texts = pool.get((d["lang"], side))
        return texts[(d["doc_id"] + i) % len(texts)] if texts and d["doc_id"] is not None else None

    return [
        (d["doc_id"], d["text"], d["lang"], d["source"], *[example(d, s, i) for s in (1, 0) for i in (0, 1)]) for d in docs
    ]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [(128, 4), (2, 1)])
def test_examples_of_comments(spark, folder, monkeypatch, block):
    monkeypatch.setattr(tb, "BLOCK_RESIDUES", block[0])
    monkeypatch.setattr(tb, "BLOCK_TURNS", block[1])
    got = tb.full_comments(spark, folder)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_comments(spark, folder), key=repr)


def test_example_texts_move_by_block(spark, folder, fixed_plans):
    # No text is carried through a sort by comment, where the four of each comment used to be picked.
    got = plan(tb.full_comments(spark, folder))
    assert "SortAggregate" not in got and "keys=[row_id" not in got


def test_distinct_rows_move_as_digests(spark, folder, fixed_plans):
    got = queries()["drop_duplicates"](spark, folder)
    expected = tr.unpivot_examples(tb.full_comments(spark, folder)).dropDuplicates()
    assert got.columns == expected.columns
    assert rows_of(got) == rows_of(expected)
    dealt = [line for line in plan(got).splitlines() if "Exchange" in line]
    assert dealt and not any("positive_example" in line for line in dealt)


def test_distinct_rows_tell_cells_apart(spark):
    rows = [("a", "b", 1, 0), ("a", "b", 1, 1), ("a", "b", 2, 0), (None, "-", 1, 2), ("-", None, 1, 3), ("1:a", "", 1, 4), ("", "1:a", 2, 1)]
    df = spark.createDataFrame(rows, "x string, y string, g int, p int").repartition("g")
    got = distinct_rows(df, group=["g"], place=["p"])
    assert rows_of(got) == rows_of(df.select("x", "y").distinct())


def test_files_of_one_community_are_many(spark, folder, tmp_path):
    comments = tb.full_comments(spark, folder, labelled=True).withColumn("subreddit", F.lit("one")).coalesce(1)
    fi.write_comments(comments, f"{tmp_path}/csv", rows_per_file=50)
    names = [n for n in os.listdir(f"{tmp_path}/csv") if n.endswith(".csv")]
    assert len(names) == -(-comments.count() // 50)
    assert rows_of(fi.scan_comments(spark, f"{tmp_path}/csv", labelled=True)) == rows_of(comments.select(fi.TRAIN_SCHEMA.names))


def test_written_comments_are_compressed(spark, folder, tmp_path):
    got = queries()["scan_comments"](spark, folder)
    names = got.inputFiles()
    assert names and all(n.endswith(".csv.gz") for n in names)
    comments = tb.full_comments(spark, folder, labelled=True).select(fi.TRAIN_SCHEMA.names)
    assert rows_of(got) == rows_of(comments)
    sizes = []
    for codec in (None, "gzip"):
        fi.write_comments(comments, f"{tmp_path}/{codec}", codec=codec)
        sizes.append(sum(e.stat().st_size for e in os.scandir(f"{tmp_path}/{codec}") if ".csv" in e.name))
    assert sizes[1] < sizes[0] / 2


def test_labels_do_not_move_texts(spark, folder, fixed_plans, no_broadcast, monkeypatch):
    def by_id():
        dealt = [line for line in plan(tb.full_comments(spark, folder, labelled=True)).splitlines() if "Exchange hashpartitioning" in line]
        return [line for line in dealt if "hashpartitioning(doc_id" in line or "hashpartitioning(row_id" in line]

    # Above the limit texts meet their labels by id; below it only examples move by id, to the blocks that take them.
    many = len(by_id())
    monkeypatch.setattr(stages, "BROADCAST_LIMIT", 64 << 20)
    assert len(by_id()) < many


def test_training_tables_are_stored_dense(spark, folder):
    stored = tr.training_tables(tb.full_comments(spark, folder, labelled=True))
    for frame in stored.values():
        names = [os.path.basename(f) for f in frame.inputFiles()]
        assert names and all(".zstd." in n for n in names)
