"""Applications, clusters and containers over time.

Everything starts from the per-file roll-up: two small shuffles, keyed by file
and then by application, carry a few numbers per file and never a log line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions.text import id_time
from tallywood.operators.parsing import group_named_files, in_application, profile_files


def app_timeline(lines: DataFrame) -> DataFrame:
    """First and last log time of every application, by start."""
    return timeline_of_files(profile_files(lines))


def timeline_of_files(files: DataFrame) -> DataFrame:
    """:func:`app_timeline` from a (stored) per-file roll-up."""
    return (
        group_named_files(
            files,
            ["application_id", "cluster_id", "app_number"],
            app_start=F.min("first_time"),
            app_end=F.max("last_time"),
        )
        .where(F.col("app_start").isNotNull() & F.col("app_end").isNotNull())
        .orderBy("app_start", "application_id")
    )


def cluster_summary(timeline: DataFrame) -> DataFrame:
    """Applications and time span per cluster, busiest first.

    The timeline has one row per application, so a plain count is the
    distinct count.
    """
    return (
        timeline.groupBy("cluster_id")
        .agg(
            F.count("*").alias("num_applications"),
            F.min("app_start").alias("cluster_first_app"),
            F.max("app_end").alias("cluster_last_app"),
        )
        .orderBy(F.desc("num_applications"), "cluster_id")
    )


def usage_totals(timeline: DataFrame) -> DataFrame:
    """One row: clusters, applications, applications per cluster (0 if none)."""
    return cluster_summary(timeline).agg(
        F.count("*").alias("total_clusters"),
        F.coalesce(F.sum("num_applications"), F.lit(0)).alias("total_applications"),
        F.coalesce(F.try_divide(F.sum("num_applications"), F.count("*")), F.lit(0.0)).alias(
            "avg_applications"
        ),
    )


def usage_report(timeline: DataFrame, top: int = 10) -> DataFrame:
    """``line_no, line`` of the usage summary text.

    Both parts aggregate the same grouped clusters, so the exchange below them
    is shared.  The list is cut to ``top`` rows before it is numbered.
    """
    totals = usage_totals(timeline).select(
        F.posexplode(
            F.array(
                F.concat(F.lit("Total unique clusters: "), F.col("total_clusters").cast("string")),
                F.concat(F.lit("Total applications: "), F.col("total_applications").cast("string")),
                F.format_string(
                    "Average applications per cluster: %.2f", F.col("avg_applications")
                ),
                F.lit(""),
                F.lit("Most heavily used clusters:"),
            )
        ).alias("line_no", "line")
    )
    busiest = (
        cluster_summary(timeline)
        .limit(top)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct((-F.col("num_applications")).alias("rank"), F.col("cluster_id"))
                )
            ).alias("clusters")
        )
        .select(F.posexplode("clusters").alias("place", "cluster"))
        .select(
            (F.col("place") + 5).alias("line_no"),
            F.format_string(
                "  Cluster %s: %d applications",
                F.col("cluster.cluster_id"),
                -F.col("cluster.rank"),
            ).alias("line"),
        )
    )
    return totals.union(busiest).orderBy("line_no")


def cluster_start(timeline: DataFrame) -> DataFrame:
    """``cluster_id, cluster_start``: the start time its id stands for."""
    return (
        timeline.select("cluster_id")
        .distinct()
        .select("cluster_id", id_time(F.col("cluster_id")).alias("cluster_start"))
    )


def container_roles(lines: DataFrame) -> DataFrame:
    """Lines and containers per application, split into master and executors.

    Lines of files without a container id count for neither.
    """
    master, count = F.col("is_app_master"), F.col("num_lines")
    container = F.nullif("container_id", F.lit(""))
    executor = ~master & container.isNotNull()
    return group_named_files(
        profile_files(lines),
        ["application_id"],
        num_lines=F.sum(count),
        num_containers=F.count_distinct(container),
        master_lines=F.sum(F.when(master, count).otherwise(0)),
        executor_lines=F.sum(F.when(executor, count).otherwise(0)),
    )


def error_rates(lines: DataFrame, by: str = "application_id") -> DataFrame:
    """Lines, error lines and their share per application (or ``container_id``).

    Lines of files without a container id are one row, whose key is NULL.
    """
    return group_named_files(
        profile_files(lines),
        [by],
        num_lines=F.sum(F.when(in_application(), F.col("num_lines"))),
        error_lines=F.sum(F.when(in_application(), F.col("error_lines"))),
    ).withColumns(
        {
            by: F.nullif(F.col(by), F.lit("")),
            "error_share": F.col("error_lines") / F.col("num_lines"),
        }
    )
