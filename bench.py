"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry import bindings  # noqa: E402

HEADLINE = [
    "mention_map", "mention_topk", "mention_scores", "mention_catalog", "clean_social", "clean_reviews", "term_stats",
    "tfidf_vocab", "tfidf_weights", "nb_train", "nb_score", "table_sentiment_ecommerce",
    "table_sentiment_social", "product_overview", "scan_social_json", "scan_reviews_csv", "html_blocks",
    "sentiment_over_time", "stream_clean",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedlark-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="feedlark-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # the session is up before the clock runs
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        bindings.queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
