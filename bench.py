"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the input tables, BENCH_CPUS the number of cores. Names of other queries
can be given as arguments; ``all`` stands for every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "r9_ranked_topics", "r2_lexicon_sentiment", "l2_tfidf", "l3_pair_cosine", "l6_greedy_clusters",
    "a1_cluster_report", "c4_drop_incomplete", "k2_insert_articles", "x1_json_script", "x2_html_dom",
    "s4_attempt_resolution", "k8_ticker_upsert", "m3_growth_schedule", "t2_article_stream",
    "r8_scoring_job", "t3_topic_stream",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from trendloom.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trendloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").collect()
    names = sys.argv[1:] or list(HEADLINE)
    if names == ["all"]:
        names = list(QUERIES)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
