"""Per-application statistics over the known messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import line_component, path_ids, whole_seconds
from tallywood.operators import messages


def component_counts(lines: DataFrame) -> DataFrame:
    """Lines of every component, most active first; NULL is "no component found"."""
    return (
        lines.select(line_component(F.col("value")).alias("component"))
        .groupBy("component")
        .agg(F.count("*").alias("num_lines"))
        .orderBy(F.desc("num_lines"), F.asc_nulls_last("component"))
    )


def top_components(lines: DataFrame, rows: int = 20) -> DataFrame:
    """The ``rows`` most active components."""
    return component_counts(lines).limit(rows)


def requested_resources(lines: DataFrame) -> DataFrame:
    """Requested containers, cores and memory per application.

    A sum that no bigint holds is NULL; so is a product, which its sum leaves out.
    """
    containers = F.col("containers")
    return (
        messages.resource_requests(lines)
        .groupBy("application_id")
        .agg(
            F.count("*").alias("num_requests"),
            F.try_sum("containers").alias("containers"),
            F.try_sum(F.try_multiply(containers, "cores")).alias("cores"),
            F.try_sum(F.try_multiply(containers, "memory_mb")).alias("memory_mb"),
            F.max("cores").alias("max_cores"),
            F.max("memory_mb").alias("max_memory_mb"),
            F.max("overhead_mb").alias("max_overhead_mb"),
        )
    )


def task_times(lines: DataFrame) -> DataFrame:
    """Start, end, whole seconds and result size of every task with a line.

    Start or end is NULL if no such line was seen.  A task that ends before it
    starts is ``out_of_order``.  ``seconds`` is NULL for both.

    A task's two lines meet by grouping on application, stage and task id, not
    by a self-join.  The task id spreads even one huge application or stage
    over all tasks of the shuffle.
    """
    begun, done = F.col("event") == "Running", F.col("event") == "Finished"
    return (
        messages.task_events(lines)
        .groupBy("application_id", "stage", "tid")
        .agg(
            F.min(F.when(begun, F.col("ts"))).alias("task_start"),
            F.max(F.when(done, F.col("ts"))).alias("task_end"),
            F.max("result_bytes").alias("result_bytes"),
        )
        .withColumn("out_of_order", F.coalesce(F.col("task_end") < F.col("task_start"), F.lit(False)))
        .withColumn("seconds", F.when(~F.col("out_of_order"), whole_seconds(F.col("task_start"), F.col("task_end"))))
    )


def _task_counts() -> list[Column]:
    """All tasks, those without an end, those that end before they start, and those with seconds."""
    return [
        F.count("*").alias("num_tasks"),
        F.count_if(F.col("task_end").isNull()).alias("num_unfinished"),
        F.count_if("out_of_order").alias("num_out_of_order"),
        F.count("seconds").alias("num_timed"),
    ]


def app_task_times(tasks: DataFrame) -> DataFrame:
    """Tasks per application, and the average and longest seconds of the timed ones."""
    return tasks.groupBy("application_id").agg(
        *_task_counts(),
        F.try_divide(F.sum("seconds"), F.count("seconds")).alias("avg_seconds"),
        F.max("seconds").alias("max_seconds"),
        F.try_sum("result_bytes").alias("result_bytes"),
    )


def stage_skew(tasks: DataFrame) -> DataFrame:
    """Spread of timed tasks' seconds per stage; ``skew`` is longest over median.

    The exact percentiles keep a count per distinct second, merged from every
    task's own counts, so their size follows the range of the seconds and not
    the number of a stage's tasks.
    """
    return (
        tasks.groupBy("application_id", "stage")
        .agg(
            *_task_counts(),
            F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY seconds)")
            .cast("bigint")
            .alias("median_seconds"),
            F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY seconds)")
            .cast("bigint")
            .alias("p95_seconds"),
            F.max("seconds").alias("max_seconds"),
        )
        .withColumn("skew", F.try_divide(F.col("max_seconds"), F.col("median_seconds")))
    )


def app_python_times(lines: DataFrame) -> DataFrame:
    """Average Python worker phases per application, in milliseconds."""

    def mean(column: str) -> Column:
        return F.try_sum(column) / F.count(column)

    return (
        messages.python_times(lines)
        .groupBy("application_id")
        .agg(
            F.count("*").alias("num_reports"),
            mean("total_ms").alias("avg_total_ms"),
            mean("boot_ms").alias("avg_boot_ms"),
            mean("init_ms").alias("avg_init_ms"),
            mean("finish_ms").alias("avg_finish_ms"),
        )
    )


def cached_bytes(lines: DataFrame) -> DataFrame:
    """Blocks stored in memory per application: number, total and largest size."""
    return (
        messages.memory_blocks(lines)
        .groupBy("application_id")
        .agg(
            F.count("*").alias("num_blocks"),
            F.try_sum("block_bytes").alias("total_bytes"),
            F.max("block_bytes").alias("max_bytes"),
            F.min("free_bytes").alias("min_free_bytes"),
        )
    )


def host_containers(lines: DataFrame) -> DataFrame:
    """Containers whose log names a worker host, per host.

    Duplicates go away on ``(host, container)`` before the count per host, so a
    host named in a third of all lines is still reduced in every task.
    """
    container = path_ids(F.col("file_path"))["container_id"]
    return (
        lines.where(F.col("value").contains("mesos-slave-"))
        .select(
            F.explode(F.regexp_extract_all("value", F.lit(P.WORKER_HOST), F.lit(0))).alias("host"),
            container.alias("container_id"),
        )
        .groupBy("host")
        .agg(
            F.count_distinct("container_id").alias("num_containers"),
            F.count("*").alias("num_mentions"),
        )
    )
