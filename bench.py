"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the cores, BENCH_RUNS the timed runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trendlake import registry  # noqa: E402
from trendlake.session import local_session  # noqa: E402

HEADLINES = (
    "silver_statistics",
    "normalize_two_formats",
    "latest_per_key",
    "dedup_removed_count",
    "enrich_category",
    "trending_analytics",
    "channel_analytics",
    "category_analytics",
    "trending_analytics_facts",
    "channel_analytics_facts",
    "category_analytics_facts",
    "channel_rank",
    "category_share",
    "region_top_videos",
    "top_categories",
    "regions_by_days",
    "table_counts",
    "dq_results",
    "dq_verdict",
    "partition_overwrite_roundtrip",
    "upsert_latest",
)


def seconds(query, spark, sf_dir: str) -> float:
    """Time to compute every row of a query, without collecting them."""
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "bench")
    times = {}
    for name in HEADLINES:
        query = registry.QUERIES[name]
        seconds(query, spark, sf_dir)
        timed = [seconds(query, spark, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(timed), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
