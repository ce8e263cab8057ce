"""The pipeline's stages on edge rows and on the smallest shared tables, and the registration of its queries."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from ruleweave.llm import catalog
from ruleweave.operators.stages import materialize

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are absent")


def test_every_operator_is_registered_once():
    names = [n for n in catalog.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in catalog.queries()


@needs_tables
def test_stages_keep_the_columns_and_take_effect(spark):
    docs, sizes = catalog.documents(spark, FOLDER), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, FOLDER))
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert 150 < sizes[0] < 200 and sizes[1] < sizes[0] and sizes[2] == sizes[1]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    copies = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert Counter(r.doc_id for r in packed if r.piece == 0) == copies and max(copies.values()) <= 3


@needs_tables
def test_stages_take_edge_rows(spark, edge, empty):
    for docs in (edge, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, FOLDER))
            assert docs.columns == columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()


def test_columns_of_any_name_keep_their_values(spark):
    rows = [(1, "some words of a text here", 77, 99, 5), (3, "another text with other words", 98, 11, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id long, _hash long, _null long")
    assert sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, "").collect())) == rows


def test_one_row_of_each_class_stays(spark, edge):
    left = corpus_pipeline.drop_near_copies(spark, edge, "").collect()
    assert Counter(r.doc_id for r in left) == Counter([1, 2, 3, 5, 7, None])


@needs_tables
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    database = duckdb.connect()
    for table in ("documents", "pages"):
        database.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    cursor = database.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    df = catalog.queries()[name](spark, FOLDER)
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(cursor.fetchall(), key=repr)
