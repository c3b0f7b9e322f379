"""Times the headline queries on $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line.

Every query runs once to warm up, then three times; its figure is the median.
Results go to Spark's no-op sink, which computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from logframe import build_session
from registered.queries import QUERIES

HEADLINE = (
    "count_all",
    "count_range",
    "count_json_between",
    "search_page",
    "search_sorted_asc",
    "search_deep_page",
    "terms_users",
    "multi_terms_orders",
    "histogram_where",
    "auto_histogram",
    "stats_value",
    "compare_users",
    "compare_report",
    "chain_top_users",
    "chain_fields",
    "match_explain",
    "text_any",
    "text_phrase",
    "text_score",
    "discover_fields",
    "discover_all",
    "top_offenders",
    "spike_causes",
    "investigate_values",
    "investigate_events",
    "pivot_nations",
    "anomalous_users",
    "spikes",
    "fan_out",
    "added_samples",
    "changed_drill",
    "list_tables",
    "scan_pattern",
)
RUNS = 3


def timed(query, spark, root) -> float:
    start = time.perf_counter()
    query(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "logframe-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(QUERIES[name], spark, root)
        runs = [timed(QUERIES[name], spark, root) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 4)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)$", root)
    print(
        json.dumps(
            {
                "metric": "total of the headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else root,
            }
        )
    )


if __name__ == "__main__":
    main()
