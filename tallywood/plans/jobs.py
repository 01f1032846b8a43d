"""Whole report jobs: lines or trips in, result folders out.

Each job reads its large input as few times as the results allow and builds
everything else from the small tables it has just written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.operators import daily, durations, levels, records, usage
from tallywood.operators.parsing import profile_files
from tallywood.sinks.files import write_report, write_table
from tallywood.sources import results

#: Bytes that opening a file counts as when records are stored.  With Spark's 4 MB a task gets 32 files,
#: however small; small ones take some 2 ms each.
OPEN_COST = 256 * 1024


def store_logs(
    lines: DataFrame, out: str, part: str = "all", sample_rows: int = 10, seed: int = 42
) -> None:
    """Reduce a log table to what the reports need and store it below ``out``.

    The logs are read twice: once for the per-file roll-up, from which all
    counts and times follow, and once for the sample.  Logs may come in parts
    of whole files, such as one cluster or one day at a time: each part keeps
    its own folder, storing it again replaces it, and the reports read them all.
    Draws are stored with their number and seed.
    """
    profile_files(lines).write.mode("overwrite").parquet(f"{out}/file_profile/part={part}")
    draws = levels.draw_lines(lines, sample_rows, seed)
    draws.withColumns({"sample_rows": F.lit(sample_rows), "seed": F.lit(seed)}).write.mode("overwrite").parquet(
        f"{out}/draws/part={part}"
    )


def write_log_reports(spark: SparkSession, out: str, sample_rows: int = 10) -> None:
    """Level and usage results below ``out`` from what :func:`store_logs` stored.

    Raises ``ValueError`` if more sample rows are asked for than each part
    stored, or if parts were drawn with different seeds.
    """
    files = spark.read.parquet(f"{out}/file_profile")
    draws = spark.read.parquet(f"{out}/draws")
    stored = draws.agg(F.min("sample_rows").alias("rows"), F.min("seed").alias("one"), F.max("seed").alias("other")).first()
    if stored.rows is not None and stored.rows < sample_rows:
        raise ValueError(f"{sample_rows} sample rows asked for, parts were stored with {stored.rows}")
    if stored.one != stored.other:
        raise ValueError(f"parts were drawn with different seeds, such as {stored.one} and {stored.other}")

    tally = levels.tally_of_files(files)
    write_table(
        levels.level_counts(tally).select("log_level", "count"),
        f"{out}/level_counts",
        single_file=True,
        order=[F.desc("count"), F.col("log_level")],
    )
    write_report(levels.level_report(tally), f"{out}/level_report")
    write_table(
        levels.best_draws(draws, sample_rows),
        f"{out}/level_sample",
        quote_all=True,
        single_file=True,
    )
    write_table(usage.timeline_of_files(files), f"{out}/timeline")
    timeline = results.read_result(spark, f"{out}/timeline", results.TIMELINE)
    write_table(usage.cluster_summary(timeline), f"{out}/cluster_summary")
    write_report(usage.usage_report(timeline), f"{out}/usage_report")


def store_records(lines: DataFrame, out: str, lines_per_part: int = records.LINES_PER_PART) -> None:
    """Multi-line records of a scan below ``out``, from one reading; :func:`read_records` returns them whole.

    While it runs, the session counts ``OPEN_COST`` for opening a file, so that a task takes many small ones.
    """
    pieces = records.record_pieces(lines, lines_per_part)
    conf, setting = lines.sparkSession.conf, "spark.sql.files.openCostInBytes"
    before = conf.get(setting)
    conf.set(setting, str(OPEN_COST))
    try:
        pieces.write.mode("overwrite").parquet(f"{out}/record_pieces/lines={lines_per_part}")
    finally:
        conf.set(setting, before)


def read_records(spark: SparkSession, out: str, lines_per_part: int = records.LINES_PER_PART) -> DataFrame:
    """``file_path, record, part, num_lines, text`` of all records that :func:`store_records` stored."""
    path = f"{out}/record_pieces/lines={lines_per_part}"
    pieces = spark.read.schema(records.PIECES).parquet(path)
    return records.whole_records(pieces, lines_per_part)


def chart_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Chart data from the stored results of :func:`write_log_reports`.

    No log is read: bars from the cluster summary; durations, histogram and
    density of the busiest cluster, and of every cluster, from the timeline.
    """
    timeline = results.read_result(spark, f"{out}/timeline", results.TIMELINE)
    top = durations.in_top_cluster(timeline)
    return {
        "applications_per_cluster": results.read_result(
            spark, f"{out}/cluster_summary", results.CLUSTER_SUMMARY
        ).orderBy(F.desc("num_applications"), "cluster_id"),
        "durations": durations.app_durations(top),
        "histogram": durations.duration_histogram(top),
        "density": durations.duration_density(top),
        "histogram_by_cluster": durations.duration_histogram(timeline),
        "density_by_cluster": durations.duration_density(timeline),
    }


def write_trip_reports(
    trips: DataFrame,
    year: int,
    out: str,
    columns: daily.TripColumns = daily.TripColumns(),
) -> DataFrame:
    """Write the daily summary (at most 366 rows) and return its roll-up."""
    write_table(
        daily.daily_summary(trips, year, columns),
        f"{out}/daily_summary",
        single_file=True,
        order=[F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day")],
    )
    stored = results.read_result(
        trips.sparkSession, f"{out}/daily_summary", results.DAILY_SUMMARY
    )
    return daily.daily_rollup(stored)
