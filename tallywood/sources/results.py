"""Stored result tables read back with typed columns, so that summaries and
chart data can be built again without touching the logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TIMELINE = (
    "application_id string, cluster_id string, app_number string,"
    " app_start timestamp_ntz, app_end timestamp_ntz"
)
CLUSTER_SUMMARY = (
    "cluster_id string, num_applications bigint,"
    " cluster_first_app timestamp_ntz, cluster_last_app timestamp_ntz"
)
LEVEL_COUNTS = "log_level string, count bigint"
DAILY_SUMMARY = (
    "dt_year int, dt_month int, dt_day int, num_trips bigint, mean_trip_distance double,"
    " max_mta_tax double, q95_fare_amount double, min_tip_amount double,"
    " mean_passenger_count bigint"
)


def read_result(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """A CSV result with header; ``schema`` is given, so no pass infers it.

    ``multi_line`` for texts that hold line ends: a file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
