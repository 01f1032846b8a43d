"""Every query that plain SQL can check, over the test tables.

``QUERIES`` maps a name to a function of session and table folder.  Log
queries read the log view of ``events``; trip queries read ``lineitem``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.operators import appstats, daily, durations, levels, messages, usage
from tallywood.operators.parsing import parse_lines, profile_files
from tallywood.plans import stored
from tallywood.sources import inventory, trip_files
from tallywood.sources.event_log import log_lines_from_events

SHIPMENTS = daily.TripColumns(
    pickup="l_shipdate",
    distance="l_quantity",
    tax="l_tax",
    fare="l_extendedprice",
    tip="l_discount",
    passengers="l_quantity",
)
SHIP_YEAR = 1998

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines_from_events(_table(spark, folder, "events"))


def _timeline(spark: SparkSession, folder: str) -> DataFrame:
    return usage.app_timeline(_lines(spark, folder))


def _tally(spark: SparkSession, folder: str) -> DataFrame:
    return levels.tally_levels(_lines(spark, folder))


def _tasks(spark: SparkSession, folder: str) -> DataFrame:
    return appstats.task_times(_lines(spark, folder))


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return daily.daily_summary(_table(spark, folder, "lineitem"), SHIP_YEAR, SHIPMENTS)


def _events_twice(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/events.parquet"
    return (
        trip_files.read_tables(spark, [path, path])
        .groupBy("event_type")
        .agg(F.count("*").alias("num_events"))
    )


QUERIES: dict[str, Query] = {
    # log levels
    "log_parse": lambda s, d: parse_lines(_lines(s, d)),
    "level_counts": lambda s, d: levels.level_counts(_tally(s, d)),
    "log_totals": lambda s, d: levels.log_totals(_tally(s, d)),
    "log_sample": lambda s, d: levels.sample_lines(_lines(s, d), 10, 42, ("event_id",)),
    "level_report_lines": lambda s, d: levels.level_report(_tally(s, d)),
    "level_occurrences": lambda s, d: levels.level_occurrences(_lines(s, d)),
    "error_lines": lambda s, d: levels.error_lines(_lines(s, d)),
    "error_lines_literal": lambda s, d: levels.error_lines(_lines(s, d), literal=True),
    # applications and clusters
    "file_profile": lambda s, d: profile_files(_lines(s, d)),
    "levels_from_files": lambda s, d: levels.tally_of_files(profile_files(_lines(s, d))),
    "app_timeline": _timeline,
    "cluster_summary": lambda s, d: usage.cluster_summary(_timeline(s, d)),
    "usage_totals": lambda s, d: usage.usage_totals(_timeline(s, d)),
    "usage_report_lines": lambda s, d: usage.usage_report(_timeline(s, d)),
    "cluster_start": lambda s, d: usage.cluster_start(_timeline(s, d)),
    "container_roles": lambda s, d: usage.container_roles(_lines(s, d)),
    "error_rates": lambda s, d: usage.error_rates(_lines(s, d)),
    "container_error_rates": lambda s, d: usage.error_rates(_lines(s, d), "container_id"),
    # files
    "application_inventory": stored.application_inventory,
    "inventory_totals": lambda s, d: inventory.inventory_totals(stored.application_inventory(s, d)),
    "largest_applications": lambda s, d: inventory.largest_applications(stored.application_inventory(s, d)),
    "timeline_from_csv": stored.timeline_from_csv,
    "histogram_from_csv": lambda s, d: stored.charts_from_csv(s, d, "histogram"),
    "density_from_csv": lambda s, d: stored.charts_from_csv(s, d, "density"),
    "level_counts_from_csv": stored.level_counts_from_csv,
    "ordered_parts_from_csv": stored.ordered_parts_from_csv,
    "quoted_csv_round_trip": stored.quoted_csv_round_trip,
    "month_folders": stored.month_folders,
    "column_profile": stored.column_profile,
    # durations
    "app_durations": lambda s, d: durations.app_durations(_timeline(s, d)),
    "top_cluster_durations": lambda s, d: durations.app_durations(
        durations.in_top_cluster(_timeline(s, d))
    ),
    "duration_histogram": lambda s, d: durations.duration_histogram(
        durations.in_top_cluster(_timeline(s, d))
    ),
    "duration_histogram_by_cluster": lambda s, d: durations.duration_histogram(_timeline(s, d)),
    "duration_density": lambda s, d: durations.duration_density(
        durations.in_top_cluster(_timeline(s, d))
    ),
    "duration_density_by_cluster": lambda s, d: durations.duration_density(_timeline(s, d)),
    # known messages
    "component_counts": lambda s, d: appstats.component_counts(_lines(s, d)),
    "top_components": lambda s, d: appstats.top_components(_lines(s, d)),
    "resource_requests": lambda s, d: messages.resource_requests(_lines(s, d)),
    "requested_resources": lambda s, d: appstats.requested_resources(_lines(s, d)),
    "container_requests": lambda s, d: messages.container_requests(_lines(s, d)),
    "task_events": lambda s, d: messages.task_events(_lines(s, d)),
    "task_times": _tasks,
    "app_task_times": lambda s, d: appstats.app_task_times(_tasks(s, d)),
    "stage_skew": lambda s, d: appstats.stage_skew(_tasks(s, d)),
    "python_times": lambda s, d: messages.python_times(_lines(s, d)),
    "app_python_times": lambda s, d: appstats.app_python_times(_lines(s, d)),
    "input_splits": lambda s, d: messages.input_splits(_lines(s, d)),
    "memory_blocks": lambda s, d: messages.memory_blocks(_lines(s, d)),
    "memory_capacities": lambda s, d: messages.memory_capacities(_lines(s, d)),
    "cached_bytes": lambda s, d: appstats.cached_bytes(_lines(s, d)),
    "broadcast_reads": lambda s, d: messages.broadcast_reads(_lines(s, d)),
    "message_counts": lambda s, d: messages.message_counts(messages.all_messages(_lines(s, d))),
    "host_containers": lambda s, d: appstats.host_containers(_lines(s, d)),
    "multiline_records": stored.multiline_records,
    # trips
    "daily_summary": _daily,
    "daily_rollup": lambda s, d: daily.daily_rollup(_daily(s, d)),
    "top_days": lambda s, d: daily.top_days(_daily(s, d)),
    "trip_totals": lambda s, d: daily.trip_totals(
        _table(s, d, "lineitem"), SHIP_YEAR, SHIPMENTS
    ),
    # sources
    "log_text_scan": stored.log_text_scan,
    "parquet_multi_scan": _events_twice,
    # Keeping the even ids is what this query does, over the whole table.
    "even_ids_doubled": lambda s, d: trip_files.even_ids_doubled(
        _table(s, d, "orders"), "o_orderkey"
    ),
    "sql_view_count": lambda s, d: trip_files.view_row_count(
        _table(s, d, "orders"), "orders_seen"
    ),
}
