import pytest
from pyspark.errors import AnalysisException

from helpers import comments, rows_of
from ruleweave.sources import files as fi


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_scan_comments(spark, tmp_path):
    path = write(
        tmp_path / "test.csv",
        "subreddit,row_id,body,rule,positive_example_1,positive_example_2,negative_example_1,negative_example_2,extra\n"
        's,1,"he said ""hi"", ok\nline2",r,NA,p2,,None,x\n'
        "s,2.0,na,r,p1,p2,n1,n2,x\n",
    )
    got = fi.scan_comments(spark, path)
    assert got.schema == fi.TEST_SCHEMA
    assert rows_of(got, "row_id", "body", "positive_example_1", "negative_example_1", "negative_example_2") == [
        (1, 'he said "hi", ok\nline2', None, None, None),
        (2, "na", "p1", "n1", "n2"),
    ]


def test_scan_labelled_and_parquet(spark, tmp_path):
    df = comments(spark, [{"row_id": 1, "body": "NA", "rule": "r", "rule_violation": 1}], labelled=True)
    df.write.parquet(str(tmp_path / "p"))
    df.write.csv(str(tmp_path / "c"), header=True)
    for got in (
        fi.scan_comments(spark, str(tmp_path / "p"), labelled=True, file_format="parquet"),
        fi.scan_comments(spark, str(tmp_path / "c"), labelled=True),
    ):
        assert got.schema == fi.TRAIN_SCHEMA
        assert rows_of(got, "row_id", "body", "rule", "rule_violation") == [(1, None, "r", 1)]


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        fi.scan_comments(spark, write(tmp_path / "t.csv", "row_id,body\n1,x\n"))


def test_load_clean(spark):
    df = comments(spark, [{"row_id": 1, "body": "http://www.a.org/b"}, {"row_id": 2}])
    assert rows_of(fi.load_clean(df), "row_id", "body") == [(1, "<url>: (a.org/b)"), (2, None)]


def test_submission_round_trip(spark, tmp_path):
    path = str(tmp_path / "sub")
    df = spark.range(100).selectExpr("id as row_id", "cast(id % 2 as int) as rule_violation", "'x' as other")
    fi.write_submission(df.repartition(5), path)
    assert rows_of(fi.read_predictions(spark, path)) == sorted(((i, float(i % 2)) for i in range(100)), key=repr)
    with pytest.raises(AnalysisException):
        fi.write_submission(df, path)


def test_predictions_pair(spark, tmp_path):
    first = write(tmp_path / "a.csv", "row_id,rule_violation\n1,0.7\n2,\n")
    second = write(tmp_path / "b.csv", "rule_violation,row_id\n1,1\n")
    a, b = fi.read_predictions_pair(spark, first, second)
    assert rows_of(a) == [(1, 0.7), (2, None)] and rows_of(b) == [(1, 1.0)]
    with pytest.raises(AnalysisException):
        fi.read_predictions_pair(spark, first, str(tmp_path / "absent.csv"))


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("row_id,rule_violation\n1,0\n2,1\n")
    (tmp_path / "b.csv").write_text("rule_violation,row_id\n0,3\n1,4\n")
    with pytest.raises(Exception, match="header"):
        fi.read_predictions(spark, str(tmp_path)).collect()


def test_fractions_are_no_whole_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("row_id,rule_violation\n1.0,0.6\n")
    assert [tuple(r) for r in fi.read_predictions(spark, str(tmp_path)).collect()] == [(1, 0.6)]
    (tmp_path / "a.csv").write_text("row_id,rule_violation\n1.7,0\n")
    with pytest.raises(Exception, match="not a whole number in row_id: 1.7"):
        fi.read_predictions(spark, str(tmp_path)).collect()


def test_comments_survive_a_round_trip(spark, tmp_path):
    rows = [(1, ' two\nlines, "quoted" ', "r", None, "a", "", "NA", "x", 1), (2, None, "r", "s", "b", "c", "d", "e", None)]
    df = spark.createDataFrame(rows, fi.TRAIN_SCHEMA)
    fi.write_comments(df.repartition(2), str(tmp_path / "c"))
    got = sorted(map(tuple, fi.scan_comments(spark, str(tmp_path / "c"), labelled=True).collect()))
    assert got == [(1, ' two\nlines, "quoted" ', "r", None, "a", None, None, "x", 1), rows[1]]
