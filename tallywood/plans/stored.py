"""Checked queries that go through files: written below the shared folder, then read back.

Each one writes what it needs from the test tables, so its files grow with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import matched
from tallywood.operators import durations, levels, usage
from tallywood.operators.parsing import profile_files
from tallywood.plans import jobs
from tallywood.sinks.files import write_line_files, write_table
from tallywood.sources import inventory, results, trip_files
from tallywood.sources.event_log import log_lines_from_events
from tallywood.sources.log_files import read_log_lines, read_positioned_log_lines

# Small parts, so that many records of the log view have several.
PART_LINES = 3
MONTHS = (1, 2, 3)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Without that setting the warehouse folder, which is always set, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallywood-{uuid.uuid4().hex}"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines_from_events(spark.read.parquet(f"{folder}/events.parquet"))


def log_text_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write the log view as text files by application, scan them, count lines.

    ``rebalance`` gives an application few files, and splits one that is too
    big for a single writer.
    """
    lines = _lines(spark, folder).select(
        "value", matched(F.col("file_path"), P.APPLICATION_ID).alias("application")
    )
    target = shared_folder(spark)
    write_line_files(lines.hint("rebalance", "application").sortWithinPartitions("application"), target, ["application"])
    scanned = read_log_lines(spark, f"{target}/application=*")
    return (
        profile_files(scanned)
        .withColumn("application_id", matched(F.col("file_path"), P.APPLICATION_ID))
        .groupBy("application_id")
        .agg(F.sum("num_lines").alias("num_lines"), F.sum("bytes").alias("bytes"))
    )


def container_files(spark: SparkSession, folder: str) -> str:
    """The log view as one text file for each container, its lines in order; returns the folder.

    A file has one writer, which sorts with spilling and streams.
    """
    path = F.col("file_path")
    target = shared_folder(spark)
    lines = (
        _lines(spark, folder)
        .select(
            "event_id",
            "value",
            matched(path, P.APPLICATION_ID).alias("application"),
            matched(path, P.CONTAINER_ID).alias("container"),
        )
        .repartition("application", "container")
        .sortWithinPartitions("application", "container", "event_id")
    )
    write_line_files(lines, target, ["application", "container"])
    return target


def multiline_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the container files, stored from one scan and read back whole."""
    out = shared_folder(spark)
    jobs.store_records(read_positioned_log_lines(spark, container_files(spark, folder)), out, PART_LINES)
    path = F.col("file_path")
    named = F.concat(F.lit("file:/logs/"), matched(path, P.APPLICATION_ID), F.lit("/"), matched(path, P.CONTAINER_ID), F.lit(".log"))
    return jobs.read_records(spark, out, PART_LINES).withColumn("file_path", named)


def application_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Files and bytes of each application, from the listing of the container files."""
    return inventory.files_by_application(inventory.list_files(spark, container_files(spark, folder)))


def timeline_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The application timeline as stored for charts, read back with its types."""
    path = f"{shared_folder(spark)}/timeline"
    write_table(usage.app_timeline(_lines(spark, folder)), path)
    return results.read_result(spark, path, results.TIMELINE)


def level_counts_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """``log_level, count`` from the stored CSV of them."""
    path = f"{shared_folder(spark)}/level_counts"
    counts = levels.level_counts(levels.tally_levels(_lines(spark, folder)))
    write_table(counts.select("log_level", "count"), path, single_file=True, order=[F.desc("count"), F.col("log_level")])
    return results.read_result(spark, path, results.LEVEL_COUNTS)


def ordered_parts_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The timeline in files that keep its order, read back: ``in_order`` if a file only holds later rows.

    Files are compared by name, by one row of each.
    """
    path = f"{shared_folder(spark)}/ordered"
    timeline = usage.app_timeline(_lines(spark, folder)).select("app_start", "application_id")
    write_table(timeline, path, order=[F.col("app_start"), F.col("application_id")])
    found = results.read_result(spark, path, "app_start timestamp_ntz, application_id string").withColumn(
        "file", F.col("_metadata.file_name")
    )
    key = F.struct("app_start", "application_id")
    files = found.groupBy("file").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    before = F.lag("last").over(Window.partitionBy().orderBy("file"))
    in_order = F.coalesce(before < F.col("first"), F.lit(True))
    checked = files.select("file", in_order.alias("in_order"))
    return found.join(checked, "file").select("application_id", "app_start", "in_order")


def quoted_csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that hold quotes, delimiters, backslashes and line ends, through a quoted CSV."""
    path = f"{shared_folder(spark)}/quoted"
    entry = F.concat("props", F.lit('\n"",\\'), "event_type", F.when(F.col("event_id") % 2 == 0, F.lit("\\")).otherwise('"'))
    events = spark.read.parquet(f"{folder}/events.parquet")
    write_table(events.select("event_id", entry.alias("log_entry")), path, quote_all=True)
    return results.read_result(spark, path, "event_id bigint, log_entry string", multi_line=True)


def month_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and quantity of three months, from a table stored in folders by year and month."""
    root = shared_folder(spark)
    shipped = F.col("l_shipdate")
    (
        spark.read.parquet(f"{folder}/lineitem.parquet")
        .select("l_quantity", F.year(shipped).alias("year"), F.month(shipped).alias("month"))
        .hint("rebalance", "year", "month")
        .write.partitionBy("year", "month")
        .parquet(root)
    )
    return (
        trip_files.read_months(spark, root, 1998, MONTHS)
        .groupBy("month")
        .agg(F.count("*").alias("num_rows"), F.sum("l_quantity").alias("quantity"))
    )


def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of ``events``, their types, and how many of their values are NULL."""
    return trip_files.profile_columns(spark.read.parquet(f"{folder}/events.parquet"))


def charts_from_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Chart data of the busiest cluster from the stored timeline; no log is read."""
    top = durations.in_top_cluster(timeline_from_csv(spark, folder))
    return durations.duration_histogram(top) if table == "histogram" else durations.duration_density(top)
