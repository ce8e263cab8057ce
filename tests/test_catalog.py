"""Every registered query against its SQL, on the smallest shared tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from ruleweave import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "conversations", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are absent")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{FOLDER}/{name}.parquet')")
    yield connection
    connection.close()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_names():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    df = catalog.queries()[name](spark, FOLDER)
    cursor = database.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.collect(), df.columns) == canonical(cursor.fetchall(), columns)


def test_text_classifier(spark):
    rows = catalog.queries()["score_text_classifier"](spark, FOLDER).collect()
    assert len(rows) == 200 and {r.reply for r in rows} <= {"Yes", "No"}


def test_train_infer_combine(spark):
    rows = catalog.queries()["train_infer_combine"](spark, FOLDER).collect()
    unlabelled = 200 - 87
    assert len({r.row_id for r in rows}) == len(rows) == unlabelled and {r.rule_violation for r in rows} <= {0.0, 1.0}
