"""Time the headline queries; prints one JSON line.

Each query runs in full (every row and column is produced, nothing is kept):
once to warm up, then three times, of which the median counts. Building the
plan is part of the time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from broadsheet.plans.catalog import REGISTRY  # noqa: E402
from broadsheet.session import local_session  # noqa: E402

HEADLINE = [
    "by_keyword",
    "by_source_limit",
    "archive_range",
    "new_items",
    "content_refresh",
    "index_upsert",
    "hot_stories",
    "thread_bfs",
    "audit_totals",
    "page_links",
    "page_articles",
    "clean_mail_lines",
    "feed_items",
    "link_list_items",
]
RUNS = 3


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "broadsheet-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries (median of warm runs)",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
