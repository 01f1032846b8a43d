"""Expressions that turn log text and file paths into typed values.

A missing part is NULL, never ``''``, and malformed input gives NULL instead
of an error, also under ANSI mode.  All times are ``timestamp_ntz``: the logs
carry no zone, so no result may depend on the session's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywood.functions import patterns as P

# Fixed value: the last millisecond of the year 9999.
LAST_MILLISECOND = 253_402_300_799_999


def matched(source: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match of ``pattern``, NULL without a match."""
    return F.nullif(F.regexp_extract(source, pattern, group), F.lit(""))


def matched_long(source: Column, pattern: str, group: int) -> Column:
    """Like :func:`matched`, as bigint; NULL if the digits do not fit one."""
    return matched(source, pattern, group).try_cast("bigint")


def stamp_time(stamp: Column) -> Column:
    """``yy/MM/dd HH:mm:ss`` text as a time in 2000-2099; NULL if no such date."""
    return F.concat(F.lit("20"), F.replace(stamp, F.lit("/"), F.lit("-"))).try_cast("timestamp_ntz")


def line_time(line: Column) -> Column:
    """Time of a line that begins with a stamp; indented stamps do not count."""
    return stamp_time(matched(line, P.STAMP_AT_START))


def starts_with_stamp(line: Column) -> Column:
    return line.rlike(P.STAMP_AT_START)


def line_level(line: Column) -> Column:
    """First level word anywhere in the line; no word boundary is asked for."""
    return matched(line, P.LEVEL)


def line_component(line: Column) -> Column:
    """Logger name between the level and the next colon."""
    return matched(line, P.COMPONENT, 2)


def path_ids(path: Column) -> dict[str, Column]:
    """Ids held by a log file's path, by column name."""
    container = matched(path, P.CONTAINER_ID)
    return {
        "application_id": matched(path, P.APPLICATION_ID),
        "cluster_id": matched(path, P.CLUSTER_ID),
        "app_number": matched(path, P.APP_NUMBER),
        "container_id": container,
        "is_app_master": F.right(container, F.lit(len(P.APP_MASTER_SUFFIX)))
        == F.lit(P.APP_MASTER_SUFFIX),
    }


def id_time(cluster_id: Column) -> Column:
    """A cluster id is its manager's start in epoch milliseconds; NULL beyond the year 9999."""
    started = cluster_id.try_cast("bigint")
    return F.timestamp_add(
        "MILLISECOND",
        F.when(started.between(0, LAST_MILLISECOND), started),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    )


def size_in_bytes(number: Column, unit: Column) -> Column:
    """``12.5`` and ``KB`` to bytes, rounded; powers of 1024; NULL if no bigint holds them."""
    factors = F.create_map(*[F.lit(x) for unit_bytes in P.UNIT_BYTES.items() for x in unit_bytes])
    return F.round(number.try_cast("double") * F.try_element_at(factors, unit)).try_cast("bigint")


def whole_seconds(start: Column, end: Column) -> Column:
    """Seconds between two zone-free times, as bigint.

    Plain subtraction: ``timestampdiff`` would go through the session zone and
    lose or gain an hour where its clocks change.
    """
    return (end - start).cast("interval second").cast("bigint")
