"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Before anything is
timed, each table is copied to a folder of as many part files as cores: the given
files have one row group, which no reader can split, unlike a table of any size.
Each query is run once to warm up and then BENCH_REPEATS times; the best time counts. The
result is written to Spark's no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opinara.catalog import QUERIES  # noqa: E402
from opinara.session import clear_work, local_session, work_path  # noqa: E402

HEADLINE = (
    "clean_corpus",
    "scored_corpus",
    "keyword_weights_top30",
    "word_cloud_top120",
    "rule_topic",
    "topic_sentiment_share",
    "tfidf_terms",
    "nb_sentiment",
    "platform_sentiment_pivot",
    "event_sentiment_pivot",
    "daily_trend",
    "headline",
    "findings",
    "body_candidates",
    "line_comments",
    "relevance_top_n",
    "landing_run",
    "cap_rows_per_group",
    "incremental_new_rows",
    "source_fallback",
)


def in_parts(spark, folder: str, parts: int) -> str:
    """The tables of ``folder`` laid out as part files; the same rows."""
    copy = work_path(spark, "tables")
    for name in sorted(os.listdir(folder)):
        if name.endswith(".parquet"):
            spark.read.parquet(f"{folder}/{name}").repartition(parts).write.parquet(f"{copy}/{name}")
    return copy


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    tables = in_parts(spark, folder, int(cores))
    times = {}
    for name in names:
        best = None
        for turn in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if turn > 0:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        spark.catalog.clearCache()
    clear_work(spark)
    report = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": int(cores),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
