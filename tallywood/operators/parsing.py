"""The parsed-log table and the per-file roll-up.

Columns nobody selects are pruned by Catalyst, so one definition serves every
query: a level count runs one pattern per line, not eight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import (
    line_component,
    line_level,
    line_time,
    matched,
    path_ids,
)


def parse_lines(lines: DataFrame) -> DataFrame:
    """All of ``lines`` plus stamp text, time, level, component and path ids."""
    value = F.col("value")
    return lines.withColumns(
        {
            "stamp_text": matched(value, P.STAMP),
            "ts": line_time(value),
            "log_level": line_level(value),
            "component": line_component(value),
            **path_ids(F.col("file_path")),
        }
    )


def in_application() -> Column:
    """Whether a file, inside a metric of :func:`group_named_files`, has an application."""
    return F.col("application_id") != ""


def group_named_files(files: DataFrame, keys: list[str], **metrics: Column) -> DataFrame:
    """Group per-file rows by path ids, leaving out files of no application.

    Ids are never NULL while grouping and the files with an application id are
    counted after it.  Metrics that mix files with and without application weigh them by
    :func:`in_application`.  A filter on the id, or one that a later join infers from a
    nullable id, would be pushed below the per-file roll-up and run a path
    pattern for every log line instead of once per file.
    """
    ids = {
        name: F.coalesce(column, F.lit("" if name != "is_app_master" else False))
        for name, column in path_ids(F.col("file_path")).items()
    }
    return (
        files.withColumns(ids)
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("application_id") != "").alias("named_files"),
            *[metric.alias(name) for name, metric in metrics.items()],
        )
        .where(F.col("named_files") > 0)
        .drop("named_files")
    )


def profile_files(lines: DataFrame) -> DataFrame:
    """One row per file: lines, bytes, lines per level, first and last time.

    Every task reduces its piece of a file to one row before the shuffle, so a
    file holding a third of all lines costs the exchange no more than one row
    per task.  Path patterns then run once per file instead of once per line.
    """
    value, level = F.col("value"), F.col("log_level")
    return (
        lines.select(
            "file_path",
            line_level(value).alias("log_level"),
            line_time(value).alias("ts"),
            (F.octet_length(value) + 1).alias("bytes"),
        )
        .groupBy("file_path")
        .agg(
            F.count("*").alias("num_lines"),
            F.sum("bytes").alias("bytes"),
            F.count_if(level == "INFO").alias("info_lines"),
            F.count_if(level == "WARN").alias("warn_lines"),
            F.count_if(level == "ERROR").alias("error_lines"),
            F.count_if(level == "DEBUG").alias("debug_lines"),
            F.min("ts").alias("first_time"),
            F.max("ts").alias("last_time"),
        )
    )
