"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from gleaner.session import SETTINGS  # noqa: E402

HEADLINE = (
    "harvest_titles",
    "harvest_stats",
    "title_job_files",
    "bag_of_words",
    "token_counts",
    "harvest_texts",
    "longest_text",
    "language_profiles",
    "detect_language",
    "harvest_detected_texts",
    "training_rows_corpus",
    "stratified_split",
    "vocabulary_topw",
    "tfidf",
    "nb_likelihoods",
    "nb_cross_validation",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    QUERIES["page_outcomes"](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
