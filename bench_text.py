"""Throughput of the log queries over plain-text files.

    python bench_text.py FOLDER [COPIES]

FOLDER is filled once with ``application=...`` folders of log lines spelled out
from the ``events`` table, each event COPIES times; a later run with the same
FOLDER only reads.  Prints one JSON line: seconds and lines per second of each
query.  Every query reads all files; nothing is cached between them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import matched
from tallywood.operators import appstats, levels, messages, usage
from tallywood.operators.parsing import profile_files
from tallywood.plans import jobs
from tallywood.sources.event_log import log_lines_from_events
from tallywood.sources.log_files import read_log_lines, read_positioned_log_lines


def write_lines(spark: SparkSession, sf_dir: str, folder: str, copies: int) -> None:
    """``copies`` log lines per event, one second apart, as text by application."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    copied = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .repartition(tasks)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("ts", F.timestamp_add("SECOND", F.col("copy"), F.col("ts")))
    )
    (
        log_lines_from_events(copied)
        .select("value", matched(F.col("file_path"), P.APPLICATION_ID).alias("application"))
        .hint("rebalance", "application")
        .write.partitionBy("application")
        .text(folder)
    )


def text_queries(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    path = f"{folder}/application=*"
    lines = read_log_lines(spark, path)
    return {
        "level_counts": lambda: levels.level_counts(levels.tally_levels(lines)),
        "app_timeline": lambda: usage.app_timeline(lines),
        "file_profile": lambda: profile_files(lines),
        "log_sample": lambda: levels.sample_lines(lines),
        "error_rates": lambda: usage.error_rates(lines),
        "component_counts": lambda: appstats.component_counts(lines),
        "requested_resources": lambda: appstats.requested_resources(lines),
        "app_task_times": lambda: appstats.app_task_times(appstats.task_times(lines)),
        "cached_bytes": lambda: appstats.cached_bytes(lines),
        "multiline_records": lambda: stored_records(spark, path, f"{folder}-records"),
        "all_messages": lambda: messages.all_messages(lines),
    }


def stored_records(spark: SparkSession, path: str, out: str) -> DataFrame:
    jobs.store_records(read_positioned_log_lines(spark, path), out)
    return jobs.read_records(spark, out)


def timed(build: Callable[[], DataFrame]) -> float:
    """Seconds to build a result and produce its last row."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def local_session(cpus: str, partitions: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallywood-bench")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "32")
    if not os.path.exists(f"{folder}/_SUCCESS"):
        write_lines(
            spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01"), folder, copies
        )
    queries = text_queries(spark, folder)
    wanted = os.environ.get("BENCH_QUERIES")
    if wanted:
        queries = {name: queries[name] for name in wanted.split(",")}
    count = read_log_lines(spark, f"{folder}/application=*").count()
    seconds = {name: timed(build) for name, build in queries.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "text log queries",
                "lines": count,
                "cpus": int(cpus),
                "seconds": seconds,
                "lines_per_second": {n: round(count / s) for n, s in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
