"""Results as CSV and text folders, written by Spark's own committers.

Large results keep their partitions: one file each, all with a header.
``single_file`` is for results of a known small size only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

#: Folder name that Spark gives a partition column without value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_table(
    df: DataFrame,
    path: str,
    quote_all: bool = False,
    single_file: bool = False,
    order: list[Column] | None = None,
) -> None:
    """``df`` as CSV with header; times as ``yyyy-MM-dd HH:mm:ss``, quotes doubled.

    ``order`` keeps rows in order: inside a single file, or over all files in
    order of their names, of which each then holds a range.
    """
    if single_file:
        df = df.repartition(1)
        if order:
            df = df.sortWithinPartitions(*order)
    elif order:
        df = df.orderBy(*order)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """A ``line_no, line`` report (a few lines) as one text file."""
    (
        report.repartition(1)
        .sortWithinPartitions("line_no")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )


def write_line_files(lines: DataFrame, path: str, by: list[str]) -> None:
    """``value`` of ``lines`` as text files in a new folder ``path``, in folders by the columns ``by``.

    Each task writes one file for every folder it has rows for, so the rows of
    a folder must follow each other in a task, as after ``sortWithinPartitions``.
    Elsewhere this is Spark's own ``partitionBy`` writer.  On a local file
    system that one starts some four processes for each file (``chmod`` of
    folders, file and checksum), about 20 ms; there, tasks write the same
    files themselves, under a hidden name until a file is whole, so that a
    task that is tried again leaves no part of one.
    """
    lines, spark = lines.select(*by, "value"), lines.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() != "file":
        lines.write.partitionBy(*by).text(path)
        return
    if system.exists(root):
        raise FileExistsError(path)
    system.mkdirs(root)
    files = lines.mapInArrow(_line_files(root.toUri().getPath(), by), "path string")
    files.write.format("noop").mode("overwrite").save()


def _line_files(root: str, by: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """See :func:`write_line_files`; a task holds one batch and one open file, and gives no rows."""

    def folder(values: tuple[str | None, ...]) -> str:
        plain = (re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda c: f"%{ord(c[0]):02X}", v or NO_VALUE) for v in values)
        return "/".join([root, *(f"{k}={v}" for k, v in zip(by, plain))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.txt"
        at = file = None

        def ended() -> None:
            if file:
                file.close()
                os.replace(file.name, f"{folder(at)}/{name}")

        for batch in batches:
            keys = [*zip(*(batch.column(i).to_pylist() for i in range(len(by))))]
            texts = [t or b"" for t in batch.column(len(by)).cast(pa.binary()).to_pylist()]
            firsts = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
            for a, b in zip(firsts, [*firsts[1:], len(keys)]):
                if keys[a] != at:
                    ended()
                    at = keys[a]
                    os.makedirs(folder(at), exist_ok=True)
                    file = open(f"{folder(at)}/.{name}.{task.taskAttemptId()}", "wb")  # noqa: SIM115
                file.write(b"\n".join(texts[a:b]) + b"\n")
        ended()
        yield from ()

    return write
