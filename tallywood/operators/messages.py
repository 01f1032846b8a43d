"""Known log messages as typed rows.

A kind of message is a fixed piece of text, a pattern and its fields.  A line
is searched for the piece first, bytes against bytes, and the pattern runs only
on lines that hold it.  No reader shuffles.  :func:`all_messages` reads all kinds
in one scan, :func:`messages_of` picks one from it; the other functions read one
kind from the lines.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import line_time, path_ids, size_in_bytes


class Kind(NamedTuple):
    """``fields`` by name: their type, and the numbers of their pattern groups."""

    marker: str
    pattern: str
    fields: dict[str, tuple[str, int] | tuple[str, int, int]]


KINDS = {
    "resource_request": Kind(
        "Will request ",
        P.RESOURCE_REQUEST,
        {"containers": ("long", 1), "cores": ("long", 2), "memory_mb": ("long", 3), "overhead_mb": ("long", 4)},
    ),
    "container_request": Kind(
        "Container request (host: ",
        P.CONTAINER_REQUEST,
        {"host": ("text", 1), "memory_mb": ("long", 2), "vcores": ("long", 3)},
    ),
    "task_event": Kind(
        " task ",
        P.TASK_EVENT,
        {
            "event": ("text", 1),
            "task": ("long", 2),
            "attempt": ("long", 3),
            "stage": ("long", 4),
            "stage_attempt": ("long", 5),
            "tid": ("long", 6),
            "result_bytes": ("long", 0),
        },
    ),
    "python_times": Kind(
        "Times: total = ",
        P.PYTHON_TIMES,
        {"total_ms": ("long", 1), "boot_ms": ("long", 2), "init_ms": ("long", 3), "finish_ms": ("long", 4)},
    ),
    "input_split": Kind(
        "Input split: ", P.INPUT_SPLIT, {"input_path": ("text", 1), "offset": ("long", 2), "length": ("long", 3)}
    ),
    "memory_block": Kind(
        "stored as bytes in memory",
        P.STORED_BLOCK,
        {"block": ("text", 1), "block_bytes": ("size", 2, 3), "free_bytes": ("size", 4, 5)},
    ),
    "memory_capacity": Kind(
        "MemoryStore started with capacity ", P.STORE_CAPACITY, {"capacity_bytes": ("size", 1, 2)}
    ),
    "broadcast_read": Kind("Started reading broadcast variable ", P.BROADCAST_READ, {"broadcast_id": ("long", 1)}),
}


def _holds(kind: str) -> Column:
    """Whether a line holds a message of this kind; most lines are done after the byte search."""
    value = F.col("value")
    return value.contains(KINDS[kind].marker) & value.rlike(KINDS[kind].pattern)


def _parts(kind: str) -> Column:
    """The groups of a kind's pattern as text, from item 1 on, of a line that holds the message.

    For tasks item 0 is the size of the result, which stands anywhere in the line.
    """
    value, pattern = F.col("value"), KINDS[kind].pattern
    groups = range(1, re.compile(pattern).groups + 1)
    head = F.lit("")
    if kind == "task_event":
        head = F.when(value.contains("bytes result"), F.regexp_extract(value, P.TASK_RESULT_BYTES, 1)).otherwise(head)
    return F.array(head, *[F.regexp_extract(value, pattern, g) for g in groups])


def all_messages(lines: DataFrame) -> DataFrame:
    """``application_id, container_id, ts, kind, parts`` of all known messages, from one scan.

    ``parts`` holds the groups of the kind's pattern as text, from item 1 on;
    :func:`messages_of` gives them names and types.  A line that holds
    messages of several kinds has a row for each.
    """
    ids = path_ids(F.col("file_path"))
    held = F.array_compact(F.array(*[F.when(_holds(k), F.lit(k)) for k in KINDS]))
    first, *others = KINDS
    parts = F.when(F.col("kind") == first, _parts(first))
    for kind in others:
        parts = parts.when(F.col("kind") == kind, _parts(kind))
    return lines.select("file_path", "value", F.explode(held).alias("kind")).select(
        ids["application_id"].alias("application_id"),
        ids["container_id"].alias("container_id"),
        line_time(F.col("value")).alias("ts"),
        "kind",
        parts.alias("parts"),
    )


def messages_of(found: DataFrame, kind: str) -> DataFrame:
    """The messages of one kind, typed, from the table of :func:`all_messages`."""
    return found.where(F.col("kind") == kind).select("application_id", "container_id", "ts", *_fields(kind))


def message_counts(found: DataFrame) -> DataFrame:
    """``kind, num_messages, num_applications`` from the table of :func:`all_messages`."""
    by_application = found.groupBy("kind", "application_id").agg(F.count("*").alias("n"))
    return by_application.groupBy("kind").agg(
        F.sum("n").alias("num_messages"), F.count("application_id").alias("num_applications")
    )


def _fields(kind: str) -> list[Column]:
    def text(group: int) -> Column:
        return F.nullif(F.get("parts", F.lit(group)), F.lit(""))

    def typed(how: str, *groups: int) -> Column:
        if how == "size":
            return size_in_bytes(*[text(g) for g in groups])
        return text(groups[0]).try_cast("bigint") if how == "long" else text(groups[0])

    return [typed(*how).alias(name) for name, how in KINDS[kind].fields.items()]


def _messages(lines: DataFrame, kind: str) -> DataFrame:
    ids = path_ids(F.col("file_path"))
    return (
        lines.where(_holds(kind))
        .select(
            ids["application_id"].alias("application_id"),
            ids["container_id"].alias("container_id"),
            line_time(F.col("value")).alias("ts"),
            _parts(kind).alias("parts"),
        )
        .select("application_id", "container_id", "ts", *_fields(kind))
    )


def resource_requests(lines: DataFrame) -> DataFrame:
    """Executor containers asked for, with cores and memory of each."""
    return _messages(lines, "resource_request")


def container_requests(lines: DataFrame) -> DataFrame:
    """Single container requests: wished host, memory, cores."""
    return _messages(lines, "container_request")


def task_events(lines: DataFrame) -> DataFrame:
    """Task starts and ends; ``result_bytes`` is NULL at a start."""
    return _messages(lines, "task_event")


def python_times(lines: DataFrame) -> DataFrame:
    """Milliseconds a Python worker spent in each phase."""
    return _messages(lines, "python_times")


def input_splits(lines: DataFrame) -> DataFrame:
    """Pieces of input files that tasks read."""
    return _messages(lines, "input_split")


def memory_blocks(lines: DataFrame) -> DataFrame:
    """Blocks put into memory: estimated size and what stayed free, in bytes."""
    return _messages(lines, "memory_block")


def memory_capacities(lines: DataFrame) -> DataFrame:
    """Capacity a container's memory store began with, in bytes."""
    return _messages(lines, "memory_capacity")


def broadcast_reads(lines: DataFrame) -> DataFrame:
    """Reads of broadcast variables."""
    return _messages(lines, "broadcast_read")
