"""Which files a path holds, and how they spread over applications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import matched


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file_path, bytes`` of every file in folders of any depth; content is not read.

    Column pruning keeps the ``content`` column out of the scan.  A path that
    does not exist raises Spark's own ``PATH_NOT_FOUND`` error.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("bytes"))
    )


def files_by_application(files: DataFrame) -> DataFrame:
    """``application_id, num_files, total_bytes`` from ``file_path, bytes`` rows."""
    return (
        files.select(matched(F.col("file_path"), P.APPLICATION_ID).alias("application_id"), "bytes")
        .where(F.col("application_id").isNotNull())
        .groupBy("application_id")
        .agg(F.count("*").alias("num_files"), F.sum("bytes").alias("total_bytes"))
    )


def inventory_totals(by_application: DataFrame) -> DataFrame:
    """One row: applications, files, bytes, and their spread per application."""
    return by_application.agg(
        F.count("*").alias("num_applications"),
        F.coalesce(F.sum("num_files"), F.lit(0)).alias("num_files"),
        F.coalesce(F.sum("total_bytes"), F.lit(0)).alias("total_bytes"),
        F.try_divide(F.sum("num_files"), F.count("*")).alias("avg_files"),
        F.min("total_bytes").alias("min_bytes"),
        F.max("total_bytes").alias("max_bytes"),
        F.try_divide(F.sum("total_bytes"), F.count("*")).alias("avg_bytes"),
    )


def largest_applications(by_application: DataFrame, rows: int = 5) -> DataFrame:
    """The applications with most files."""
    return by_application.orderBy(F.desc("num_files"), "application_id").limit(rows)
