"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then BENCH_RUNS times; the median is reported. A run
computes all rows and columns and throws them away, so no sink or driver transfer is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from panelkit.catalog import QUERIES
from panelkit.session import session

HEADLINE = [
    "demographic_share",
    "line_share_of_largest_return",
    "tree_labels",
    "tree_attach",
    "composite_lookup",
    "distinct_no_file",
    "precedence_union",
    "backfill",
    "new_period_labels",
    "round_metrics",
    "code_coverage",
    "duplicate_report",
    "chunk_numbers",
    "chunk_files",
    "old_format_prepared",
    "new_format_processed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    conf = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
    }
    spark = session("panelkit-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
