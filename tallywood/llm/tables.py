"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallywood-{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once as Parquet and read again: the lineage ends here.

    Unlike a cache this survives lost executors, and values that depend on how
    rows were dealt out (row numbers, partition ids) stay what they were.
    """
    path = shared_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    if (made := _written.get()) is not None:
        made.append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def narrowed(frame: DataFrame, rows: int, each: int) -> DataFrame:
    """``frame`` in one task for every ``each`` of ``rows`` rows, or in as many tasks as it has if these are fewer.

    Small tables so don't get a task and a file for each shuffle partition.
    """
    return frame.coalesce(max(1, -(-rows // each)))


def stored_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, :func:`stored`; the tables stored on the way to it are deleted then.

    They are deleted only once the result is written whole, so nothing that can
    still be lost depends on them.  Frames made inside ``build`` must not be
    used after it.  If it fails, its tables stay.
    """
    made: list[str] = []
    token = _written.set(made)
    try:
        result = stored(build(), label)
    finally:
        _written.reset(token)
    *before, last = made
    for path in before:
        _delete(spark, path)
    if (outer := _written.get()) is not None:
        outer.append(last)
    return result


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
