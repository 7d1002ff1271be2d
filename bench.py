"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. Every query
runs to its last row through the ``noop`` sink; each is warmed up once, then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedloom.catalog.queries import QUERIES  # noqa: E402
from feedloom.session import build_session  # noqa: E402

HEADLINE = (
    "feed_top_n",
    "feed_batch",
    "anti_seen",
    "score_join",
    "score_upsert",
    "thread_text",
    "mute_any",
    "mute_matches_long",
    "news_flag",
    "news_ids",
    "neg_ids",
    "label_set",
    "clean_text",
    "top_words",
    "top_ngrams",
    "top_tfidf",
    "class_report",
    "runs_ordered",
    "dq_checks",
    "table_fingerprint",
    "stream_ingest",
    "stream_score",
    "ngram_counts",
    "mute_drop_long",
    "deliver_batch",
    "feed_positions",
    "score_upsert_buckets",
    "stream_ingest_files",
    "version_diff",
)


def run(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name, spark, sf_dir)
        seconds[name] = round(run(name, spark, sf_dir), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
