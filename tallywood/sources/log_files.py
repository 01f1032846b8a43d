"""Container log files as one row per text line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, file_path`` of every line below ``path`` (any Hadoop URI or glob), in folders of any depth.

    ``file_path`` comes from the scan's own metadata, so it survives shuffles.
    Task size follows ``spark.sql.files.maxPartitionBytes`` and a large
    uncompressed file is split over many tasks.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file_path"))


def read_positioned_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, file_path, block, pos``: lines with their order inside the file.

    ``block`` is the byte offset at which the scan's piece of the file starts.
    ``pos`` is a row id that no other line shares and that grows with the lines
    of one block.  It is taken directly at the scan, below any shuffle or
    filter, where a task reads its piece from front to back.
    """
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
