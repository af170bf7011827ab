"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of threads. Each
query runs once to warm up and then three times; the middle time counts. The
result is written to nowhere, so that all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

import checks

HEADLINES = (
    "dedup_both_passes", "existing_urls", "resolve_source_id",
    "score_news", "filter_positive", "hint_hit_counts", "lexicon_match",
    "limit_per_source", "global_cap", "feed_entries_rss", "feed_entries_atom",
    "clean_url", "thumbnail_chain", "reddit_page_link",
    "topic_scores", "summarize_batch", "stage_funnel",
    "batch_collapse", "upsert_articles", "export_order", "run_batch",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checks.load_all()

    def once(name: str) -> float:
        started = time.perf_counter()
        checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times: dict[str, float] = {}
    for name in HEADLINES:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
