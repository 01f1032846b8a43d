"""Log levels: distribution, totals, sample, report, error lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import line_level, line_time, path_ids


def tally_levels(lines: DataFrame) -> DataFrame:
    """``log_level, num_lines, count``: one row per level, one for lines without.

    At most five rows.  ``count`` counts the level itself, so it is 0 for the
    lines that have none.  Later steps filter on it and not on the level: such
    a filter stays above the aggregate, where a filter on the level would be
    pushed below it and run the pattern twice per line.
    """
    return (
        lines.select(line_level(F.col("value")).alias("log_level"))
        .groupBy("log_level")
        .agg(F.count("*").alias("num_lines"), F.count("log_level").alias("count"))
    )


def tally_of_files(files: DataFrame) -> DataFrame:
    """:func:`tally_levels` from a (stored) per-file roll-up, without any line."""
    sums = files.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("num_lines", "info_lines", "warn_lines", "error_lines", "debug_lines")
        ]
    )
    without = F.expr("num_lines - info_lines - warn_lines - error_lines - debug_lines")
    rows = F.array(
        *[
            F.struct(
                F.lit(level).alias("log_level"),
                F.col(column).alias("num_lines"),
                F.col(column).alias("count"),
            )
            for level, column in (
                ("INFO", "info_lines"),
                ("WARN", "warn_lines"),
                ("ERROR", "error_lines"),
                ("DEBUG", "debug_lines"),
            )
        ],
        F.struct(
            F.lit(None).cast("string").alias("log_level"),
            without.alias("num_lines"),
            F.lit(0).cast("bigint").alias("count"),
        ),
    )
    return sums.select(F.inline(rows)).where(F.col("num_lines") > 0)


def level_counts(tally: DataFrame) -> DataFrame:
    """``log_level, count, percent`` of the lines that hold a level."""
    # At most four rows reach this window.
    everything = Window.partitionBy()
    return (
        tally.where(F.col("count") > 0)
        .select(
            "log_level",
            "count",
            (F.col("count") / F.sum("count").over(everything) * 100).alias("percent"),
        )
        .orderBy(F.desc("count"), "log_level")
    )


def log_totals(tally: DataFrame) -> DataFrame:
    """One row: all lines, lines with a level, distinct levels."""
    return tally.agg(
        F.coalesce(F.sum("num_lines"), F.lit(0)).alias("total_lines"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("lines_with_level"),
        F.count_if(F.col("count") > 0).alias("distinct_levels"),
    )


def draw_lines(
    lines: DataFrame,
    rows: int = 10,
    seed: int | None = 42,
    keys: tuple[str, ...] = ("file_path",),
) -> DataFrame:
    """``draw, log_entry, log_level`` of ``rows`` lines drawn from those with a level.

    With a seed the draw is repeatable whatever the partitioning: lines are
    ordered by a hash of seed, ``keys`` and text.  ``seed=None`` draws anew on
    every run.  Each task keeps only its own ``rows`` best lines: no sort of
    the logs, as long as nothing but a plain projection follows the limit.
    """
    if seed is None:
        draw = F.format_string("%.17f", F.rand())
    else:
        parts = [F.col(k).cast("string") for k in keys]
        draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts, F.col("value")))
    return (
        lines.where(F.col("value").rlike(P.LEVEL))
        # A column of its own: an ordering expression runs at every comparison.
        .select("value", draw.alias("draw"))
        .orderBy("draw")
        .limit(rows)
        .select(
            "draw",
            F.col("value").alias("log_entry"),
            F.regexp_extract("value", P.LEVEL, 1).alias("log_level"),
        )
    )


def sample_lines(
    lines: DataFrame,
    rows: int = 10,
    seed: int | None = 42,
    keys: tuple[str, ...] = ("file_path",),
) -> DataFrame:
    """``log_entry, log_level`` of the lines :func:`draw_lines` draws."""
    return draw_lines(lines, rows, seed, keys).drop("draw")


def best_draws(draws: DataFrame, rows: int = 10) -> DataFrame:
    """The sample of all logs from the stored draws of their parts."""
    return draws.orderBy("draw").limit(rows).select("log_entry", "log_level")


def level_report(tally: DataFrame) -> DataFrame:
    """``line_no, line`` of the level summary text."""
    ranked = F.array_sort(
        F.collect_list(
            F.when(
                F.col("count") > 0,
                F.struct((-F.col("count")).alias("rank"), F.col("log_level").alias("level")),
            )
        )
    )  # holds at most four levels
    totals = tally.agg(
        F.coalesce(F.sum("num_lines"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("with_level"),
        ranked.alias("levels"),
    )

    def level_line(entry: Column) -> Column:
        count = -entry["rank"]
        percent = count / F.col("with_level") * 100
        return F.format_string("  %-5s: %10d (%6.2f%%)", entry["level"], count, percent)

    head = F.array(
        F.concat(F.lit("Total log lines processed: "), F.col("total").cast("string")),
        F.concat(F.lit("Total lines with log levels: "), F.col("with_level").cast("string")),
        F.concat(F.lit("Unique log levels found: "), F.size("levels").cast("string")),
        F.lit(""),
        F.lit("Log level distribution:"),
    )
    text = F.concat(head, F.transform("levels", level_line))
    return totals.select(F.posexplode(text).alias("line_no", "line"))


def level_occurrences(lines: DataFrame) -> DataFrame:
    """``log_level, occurrences``: every hit counts, also several in one line."""
    return (
        lines.select(
            F.explode(F.regexp_extract_all("value", F.lit(P.LEVEL), F.lit(1))).alias("log_level")
        )
        .groupBy("log_level")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "log_level")
    )


def error_lines(lines: DataFrame, literal: bool = False) -> DataFrame:
    """``application_id, container_id, ts, value`` of error lines.

    By default those whose level is ``ERROR``; ``literal=True`` takes every
    line that holds the word anywhere.
    """
    value = F.col("value")
    wanted = value.contains("ERROR")
    if not literal:
        wanted = wanted & (line_level(value) == "ERROR")
    ids = path_ids(F.col("file_path"))
    return lines.where(wanted).select(
        ids["application_id"].alias("application_id"),
        ids["container_id"].alias("container_id"),
        line_time(value).alias("ts"),
        "value",
    )
