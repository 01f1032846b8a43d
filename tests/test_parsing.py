import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywood.functions import text
from tallywood.operators.parsing import group_named_files, parse_lines, profile_files
from tests.logs import APP, FILE_1, PARSED, log_frame, rows, sample_log


def one(spark, expression, **values):
    names = list(values)
    schema = ", ".join(f"{n} string" for n in names) or "unused string"
    df = spark.createDataFrame([tuple(values.values()) or ("",)], schema)
    return df.select(expression).first()[0]


def test_levels_and_times(spark):
    got = rows(parse_lines(sample_log(spark)).select("value", "log_level", F.col("ts").cast("string")))
    assert got == PARSED


def test_stamp_text_is_found_anywhere(spark):
    got = rows(parse_lines(sample_log(spark)).select("stamp_text"))
    assert [g[0] for g in got] == [
        "17/03/29 10:04:41", "17/03/29 10:05:41", "17/03/29 10:04:50",
        None, None, None, "17/13/40 10:00:00", None,
    ]


def test_components(spark):
    lines = log_frame(
        spark,
        [
            ("17/03/29 10:04:41 INFO storage.MemoryStore: x: y", FILE_1),
            ("17/03/29 10:04:41 INFO no colon here", FILE_1),
            ("DEBUG   two words: rest", FILE_1),
            ("nothing: at all", FILE_1),
        ],
    )
    got = rows(parse_lines(lines).select("component"))
    assert [g[0] for g in got] == ["storage.MemoryStore", None, "two words", None]


def test_path_ids(spark):
    lines = log_frame(spark, [("x", FILE_1), ("x", FILE_1.replace("000001", "000017")), ("x", "/tmp/a.log")])
    got = rows(
        parse_lines(lines).select(
            "application_id", "cluster_id", "app_number", "container_id", "is_app_master"
        )
    )
    assert got == [
        (APP, "1512345678901", "0007", "container_1512345678901_0007_01_000001", True),
        (APP, "1512345678901", "0007", "container_1512345678901_0007_01_000017", False),
        (None, None, None, None, None),
    ]


@pytest.mark.parametrize(
    "stamp, expected",
    [
        ("17/03/29 10:04:41", dt.datetime(2017, 3, 29, 10, 4, 41)),
        ("99/12/31 23:59:59", dt.datetime(2099, 12, 31, 23, 59, 59)),
        ("00/01/01 00:00:00", dt.datetime(2000, 1, 1)),
        ("17/02/29 00:00:00", None),
        ("16/02/29 00:00:00", dt.datetime(2016, 2, 29)),
        ("17/03/29 24:00:00", None),
        ("17/03/29 10:60:00", None),
        # Exists in no New York clock, but logs have no zone.
        ("17/03/12 02:30:00", dt.datetime(2017, 3, 12, 2, 30)),
    ],
)
def test_stamp_time(spark, stamp, expected):
    assert one(spark, text.line_time(F.col("v")), v=stamp + " INFO a: b") == expected


def test_seconds_do_not_follow_the_session_zone(spark):
    got = one(
        spark,
        text.whole_seconds(
            F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
        ),
        a="2017-03-12 00:00:00",
        b="2017-03-12 12:00:00",
    )
    assert got == 12 * 3600


def test_cluster_id_is_a_time(spark):
    got = one(spark, text.id_time(F.col("v")), v="1485248649253")
    assert got == dt.datetime(2017, 1, 24, 9, 4, 9, 253000)
    assert one(spark, text.id_time(F.col("v")), v="no number") is None


@pytest.mark.parametrize(
    "number, unit, size",
    [
        ("12", "B", 12),
        ("1.5", "KB", 1536),
        ("2.0", "MB", 2 * 1024**2),
        ("17.8", "GB", round(17.8 * 1024**3)),
        ("1", "TB", None),
        ("1.2.3", "KB", None),
    ],
)
def test_sizes(spark, number, unit, size):
    assert one(spark, text.size_in_bytes(F.col("n"), F.col("u")), n=number, u=unit) == size


def test_profile_counts_every_line(spark):
    (got,) = rows(profile_files(sample_log(spark)))
    assert got == (
        FILE_1, 8, sum(len(line) + 1 for line, _, _ in PARSED),
        2, 1, 1, 1,
        dt.datetime(2017, 3, 29, 10, 4, 41), dt.datetime(2017, 3, 29, 10, 5, 41),
    )


def test_files_of_no_application_are_left_out(spark):
    lines = log_frame(spark, [("x", FILE_1), ("y", "/var/log/syslog"), ("z", "/var/log/other")])
    got = group_named_files(profile_files(lines), ["application_id"], n=F.sum("num_lines"))
    assert rows(got) == [(APP, 1)]
