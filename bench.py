"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ruleweave import catalog
from ruleweave.operators.stages import release
from ruleweave.session import local_session

HEADLINE = [
    "centroid_classify",
    "rule_centroids",
    "full_inference",
    "ensemble_weighted",
    "ensemble_override",
    "triplet_dataset",
    "triplet_margin_loss",
    "prompt_dataset",
    "pseudo_training_set",
    "sample_stratified",
    "sample_n",
    "shuffle_batches",
    "join_positive",
    "join_negative",
    "join_text_embedding",
    "join_predictions",
    "distinct_texts",
    "clean_urls",
    "build_prompt",
    "embed_texts",
    "score_batches",
    "score_text_classifier",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = round(time.perf_counter() - start, 3)
        release(spark)
        return seconds

    # JVM start and code compilation belong to no query.
    for name in ("centroid_classify", "clean_urls"):
        run(name)
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
