import pytest

from helpers import comments, rows_of
from test_inference import VECTORS, sample, vectors

from ruleweave.operators.centroids import rule_centroids
from ruleweave.plans.inference import centroid_classify
from ruleweave.streaming.scoring import score_stream, stream_comments


def test_cleaning_on_a_stream(spark, tmp_path):
    df = comments(spark, [{"row_id": i, "body": f"at http://www.a.org/{i}/x/y?q"} for i in range(50)])
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    query = (
        stream_comments(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        .select("row_id", "body")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    got = spark.read.schema("row_id long, body string").parquet(str(tmp_path / "out"))
    assert rows_of(got) == sorted(((i, f"at <url>: (a.org/{i}/x)") for i in range(50)), key=repr)


@pytest.mark.parametrize("pieces", [False, True])
def test_scoring_a_stream(spark, tmp_path, pieces, request):
    """Also with every repeated text taken as a hot one."""
    if pieces:
        request.getfixturevalue("small_pieces")
    batch = sample(spark)
    batch.repartition(2).write.parquet(str(tmp_path / "in"))
    table = vectors(spark, VECTORS)
    centroids = rule_centroids(batch, table, dim=2)
    query = score_stream(
        stream_comments(spark, str(tmp_path / "in")),
        table,
        centroids,
        output=str(tmp_path / "out"),
        checkpoint=str(tmp_path / "state"),
    )
    query.awaitTermination(120)
    got = spark.read.schema("row_id long, rule_violation int").parquet(str(tmp_path / "out"))
    assert rows_of(got, "row_id", "rule_violation") == rows_of(centroid_classify(batch, table, dim=2))
