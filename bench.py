"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 5): one warm-up and then the median of the runs, each written out with
the noop sink so that every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.registry import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "int_user_journey",
    "mart_user_growth",
    "mart_event_funnel",
    "mart_revenue",
    "mart_revenue_orders",
    "mart_platform_split",
    "event_metrics_summary",
    "metric_samples",
    "dashboard_kpis",
    "dq_report",
    "daily_samples",
    "ga4_normalize",
    "ingest_batch_policy_atomic",
    "ingest_batch_policy_lenient",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for key in keys:
        once(key)
        seconds[key] = round(statistics.median(once(key) for _ in range(runs)), 4)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
