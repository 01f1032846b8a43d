"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local threads.
Every query runs once to warm up and is then timed to its last row.  Six log
queries are also timed on plain text, ``TEXT_COPIES`` lines per event written
to a folder of its own, since the published baseline counts text lines.
"""

from __future__ import annotations

import json
import os
import tempfile

import pyarrow.parquet as pq

from bench_text import local_session, text_queries, timed, write_lines
from tallywood.plans.checked import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "level_counts",
    "log_totals",
    "log_sample",
    "level_report_lines",
    "file_profile",
    "app_timeline",
    "cluster_summary",
    "usage_totals",
    "usage_report_lines",
    "container_roles",
    "error_rates",
    "duration_histogram",
    "duration_density",
    "duration_histogram_by_cluster",
    "component_counts",
    "requested_resources",
    "app_task_times",
    "stage_skew",
    "app_python_times",
    "cached_bytes",
    "host_containers",
    "multiline_records",
    "daily_summary",
    "daily_rollup",
    "trip_totals",
    "parquet_multi_scan",
)


TEXT_QUERIES = (
    "level_counts",
    "app_timeline",
    "file_profile",
    "app_task_times",
    "cached_bytes",
    "multiline_records",
)
TEXT_COPIES = 50


def main() -> None:
    spark = local_session(CPUS, CPUS)
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            seconds[name] = timed(lambda: QUERIES[name](spark, SF_DIR))
    with tempfile.TemporaryDirectory(prefix="tallywood-bench-") as scratch:
        folder = f"{scratch}/logs"
        write_lines(spark, SF_DIR, folder, TEXT_COPIES)
        text = text_queries(spark, folder)
        for name in TEXT_QUERIES:
            for _ in range(2):
                seconds[f"text_{name}"] = timed(text[name])
        spark.stop()
    lines = TEXT_COPIES * table_rows("events")
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "text_lines": lines,
                "text_lines_per_second": {
                    name: round(lines / seconds[f"text_{name}"]) for name in TEXT_QUERIES
                },
            }
        )
    )


def table_rows(name: str) -> int:
    return pq.ParquetFile(f"{SF_DIR}/{name}.parquet").metadata.num_rows


if __name__ == "__main__":
    main()
