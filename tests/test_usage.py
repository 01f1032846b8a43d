import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywood.operators import usage
from tests.logs import FILE_1, FILE_2, log_frame, rows

TIMELINE = (
    "application_id string, cluster_id string, app_number string,"
    " app_start timestamp_ntz, app_end timestamp_ntz"
)


def path(cluster, app, container):
    return f"s3a://b/application_{cluster}_{app}/container_{cluster}_{app}_01_{container}.log"


@pytest.fixture
def lines(spark):
    return log_frame(
        spark,
        [
            ("17/01/01 00:00:05 INFO a: b", path(20, "0001", "000002")),
            ("17/01/01 00:00:09 INFO a: b", path(20, "0001", "000001")),
            ("17/01/01 00:00:01 ERROR a: b", path(20, "0001", "000001")),
            ("no stamp", path(20, "0001", "000001")),
            ("17/01/01 00:00:00 INFO a: b", path(10, "0007", "000001")),
            ("17/99/01 00:00:00 INFO a: b", path(10, "0008", "000001")),
            ("no stamp", path(30, "0009", "000001")),
            ("17/01/01 00:00:00 INFO a: b", "s3a://b/readme.log"),
        ],
    )


def at(seconds):
    return dt.datetime(2017, 1, 1) + dt.timedelta(seconds=seconds)


def test_timeline(lines):
    assert rows(usage.app_timeline(lines)) == [
        ("application_10_0007", "10", "0007", at(0), at(0)),
        ("application_20_0001", "20", "0001", at(1), at(9)),
    ]


def test_summary_breaks_ties_by_id(lines):
    assert rows(usage.cluster_summary(usage.app_timeline(lines))) == [
        ("10", 1, at(0), at(0)),
        ("20", 1, at(1), at(9)),
    ]


def test_totals(spark, lines):
    assert rows(usage.usage_totals(usage.app_timeline(lines))) == [(2, 2, 1.0)]
    nothing = spark.createDataFrame([], TIMELINE)
    assert rows(usage.usage_totals(nothing)) == [(0, 0, 0.0)]


def published_timeline(spark):
    """As many applications per cluster as the published run had."""
    sizes = {
        "1485248649253": 181, "1472621869829": 8, "1448006111297": 2,
        "1474351042505": 1, "1440487435730": 1, "1460011102909": 1,
    }
    return spark.createDataFrame(
        [
            (f"application_{c}_{i:04d}", c, f"{i:04d}", at(i), at(i + 60))
            for c, n in sizes.items()
            for i in range(n)
        ],
        TIMELINE,
    )


def test_report_has_the_published_form(spark):
    report = usage.usage_report(published_timeline(spark)).orderBy("line_no")
    lines = [r.line for r in report.collect()]
    assert lines == [
        "Total unique clusters: 6",
        "Total applications: 194",
        "Average applications per cluster: 32.33",
        "",
        "Most heavily used clusters:",
        "  Cluster 1485248649253: 181 applications",
        "  Cluster 1472621869829: 8 applications",
        "  Cluster 1448006111297: 2 applications",
        "  Cluster 1440487435730: 1 applications",
        "  Cluster 1460011102909: 1 applications",
        "  Cluster 1474351042505: 1 applications",
    ]


def test_report_lists_ten_clusters_at_most(spark):
    timeline = spark.createDataFrame(
        [(f"application_{c}_1", str(c), "1", at(0), at(1)) for c in range(100, 125)], TIMELINE
    )
    report = rows(usage.usage_report(timeline).orderBy("line_no"))
    assert [n for n, _ in report] == list(range(15))
    assert report[5][1] == "  Cluster 100: 1 applications"


def test_cluster_start(spark):
    got = rows(usage.cluster_start(published_timeline(spark)).orderBy("cluster_id"))
    assert len(got) == 6
    assert got[0] == ("1440487435730", dt.datetime(2015, 8, 25, 7, 23, 55, 730000))


def test_roles_and_rates(lines):
    roles = {r[0]: r[1:] for r in rows(usage.container_roles(lines))}
    assert roles["application_20_0001"] == (4, 2, 3, 1)
    assert roles["application_30_0009"] == (1, 1, 1, 0)
    assert len(roles) == 4
    rates = {r[0]: r[1:] for r in rows(usage.error_rates(lines))}
    assert rates["application_20_0001"] == (4, 1, 0.25)
    by_container = {r[0]: r[1:] for r in rows(usage.error_rates(lines, "container_id"))}
    assert by_container["container_20_0001_01_000001"] == (3, 1, 1 / 3)


def test_one_application_with_most_lines(spark):
    hot = spark.range(50_000).select(
        F.expr(
            "concat('17/01/01 ', lpad(id % 24, 2, '0'), ':00:', lpad(id % 60, 2, '0'), ' INFO a: b')"
        ).alias("value"),
        F.when(F.col("id") % 2 == 0, FILE_1).otherwise(FILE_2).alias("file_path"),
    )
    (got,) = rows(usage.app_timeline(hot.repartition(16)))
    assert got[3:] == (at(0), dt.datetime(2017, 1, 1, 23, 0, 59))
