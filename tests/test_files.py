"""Reading and writing files: log folders, parquet layouts, result folders."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallywood.operators import usage
from tallywood.operators.parsing import parse_lines, profile_files
from tallywood.plans import jobs
from tallywood.sinks.files import write_line_files, write_report, write_table
from tallywood.sources import inventory, results, trip_files
from tallywood.sources.results import read_result
from tallywood.sources.trip_files import profile_columns, read_months
from tallywood.sources.log_files import read_log_lines
from tests.logs import FILE_1, log_frame, rows


@pytest.fixture
def logs(tmp_path):
    root = tmp_path / "logs"
    for cluster, app, containers in (("20", "0001", 3), ("20", "0002", 1), ("10", "0007", 2)):
        folder = root / f"application_{cluster}_{app}"
        folder.mkdir(parents=True)
        for c in range(1, containers + 1):
            (folder / f"container_{cluster}_{app}_01_{c:06d}.log").write_text(
                f"17/01/01 00:00:0{c} INFO a: b\n  more\n17/01/01 00:01:0{c} WARN a: \"c\"\n"
            )
    return root


def texts(folder):
    """Non-empty part files of a result folder, as lists of lines."""
    parts = [p.read_text().splitlines() for p in sorted(Path(folder).glob("part-*"))]
    return [p for p in parts if p]


def test_log_scan(spark, logs):
    lines = read_log_lines(spark, f"{logs}/application_*/*")
    assert lines.columns == ["value", "file_path"]
    assert lines.count() == 18
    timeline = rows(usage.app_timeline(lines))
    assert [(r[0], r[2], r[3].second, r[4].second) for r in timeline] == [
        ("application_10_0007", "0007", 1, 2),
        ("application_20_0001", "0001", 1, 3),
        ("application_20_0002", "0002", 1, 1),
    ]


def test_path_survives_a_shuffle(spark, logs):
    lines = read_log_lines(spark, f"{logs}/application_*/*").repartition(7)
    assert parse_lines(lines).where("container_id IS NULL").count() == 0


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\r\ntwo\rthree\n\nfour")
    got = [r.value for r in read_log_lines(spark, str(tmp_path)).collect()]
    assert got == ["one", "two", "three", "", "four"]


def test_several_paths(spark, logs):
    paths = [f"{logs}/application_20_0001", f"{logs}/application_10_0007"]
    assert read_log_lines(spark, paths).count() == 15


def test_missing_path_is_reported(spark, tmp_path):
    for read in (read_log_lines, inventory.list_files):
        with pytest.raises(AnalysisException) as error:
            read(spark, str(tmp_path / "nothing" / "*")).count()
        assert error.value.getCondition() == "PATH_NOT_FOUND"


def test_inventory(spark, logs):
    files = inventory.list_files(spark, f"{logs}/application_*/*")
    by_application = inventory.files_by_application(files)
    size = len('17/01/01 00:00:01 INFO a: b\n  more\n17/01/01 00:01:01 WARN a: "c"\n')
    assert rows(inventory.largest_applications(by_application, 2)) == [
        ("application_20_0001", 3, 3 * size), ("application_10_0007", 2, 2 * size),
    ]
    assert rows(inventory.inventory_totals(by_application)) == [
        (3, 6, 6 * size, 2.0, size, 3 * size, 2.0 * size)
    ]
    # The same numbers follow from the lines.
    lines = read_log_lines(spark, f"{logs}/application_*/*")
    from_lines = inventory.files_by_application(profile_files(lines).select("file_path", "bytes"))
    assert sorted(rows(from_lines)) == sorted(rows(by_application))


def test_inventory_of_nothing(spark):
    nothing = spark.createDataFrame([], "file_path string, bytes bigint")
    totals = inventory.inventory_totals(inventory.files_by_application(nothing))
    assert rows(totals) == [(0, 0, 0, None, None, None, None)]


def test_parquet_paths_and_folders(spark, tmp_path):
    for year in (2020, 2021):
        for month in (1, 2, 3):
            spark.range(month).selectExpr(f"{year}{month:02d} AS id").coalesce(1).write.parquet(
                f"{tmp_path}/yyyy={year}/trips_{year}-{month:02d}.parquet"
            )
    template = f"{tmp_path}/yyyy={{year}}/trips_{{year}}-{{month:02d}}.parquet"
    paths = trip_files.monthly_paths(template, (2, 3), 2021)
    assert paths[0].endswith("/yyyy=2021/trips_2021-02.parquet")
    assert trip_files.read_tables(spark, paths).count() == 5
    assert trip_files.read_tables(spark, paths * 2).count() == 10
    table = trip_files.read_partitioned(spark, str(tmp_path), "yyyy=*/*.parquet")
    assert sorted(rows(table.groupBy("yyyy").count())) == [(2020, 6), (2021, 6)]
    one_year = table.where("yyyy = 2021").select("id")
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan
    assert one_year.count() == 6


def test_columns_and_preview(spark):
    df = spark.range(100).selectExpr("id", "cast(id AS string) AS name")
    assert rows(trip_files.describe_columns(spark, df)) == [
        (0, "id", "bigint", False), (1, "name", "string", False),
    ]
    assert trip_files.preview(df).count() == 5


def test_install_check(spark):
    ids = spark.range(1000)
    doubled = trip_files.even_ids_doubled(ids)
    assert (doubled.count(), doubled.agg(F.max("doubled")).first()[0]) == (500, 1996)
    assert rows(trip_files.view_row_count(ids, "numbers")) == [(1000,)]


def test_table_form(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 'say "hi", now', dt.datetime(2017, 1, 24, 17, 0, 28)), ("b", None, None)],
        "k string, v string, t timestamp_ntz",
    )
    write_table(df, f"{tmp_path}/t", single_file=True, order=[F.desc("k")])
    assert texts(f"{tmp_path}/t") == [
        ["k,v,t", "b,,", 'a,"say ""hi"", now",2017-01-24 17:00:28']
    ]
    back = results.read_result(spark, f"{tmp_path}/t", "k string, v string, t timestamp_ntz")
    assert sorted(rows(back)) == sorted(rows(df))


def test_large_tables_keep_their_parts(spark, tmp_path):
    write_table(spark.range(100).repartition(4), f"{tmp_path}/t")
    parts = texts(f"{tmp_path}/t")
    assert len(parts) == 4 and all(p[0] == "id" for p in parts)


def test_report_keeps_its_order(spark, tmp_path):
    report = spark.range(50).repartition(8).selectExpr("id AS line_no", "concat('l', id) AS line")
    write_report(report, f"{tmp_path}/r")
    assert texts(f"{tmp_path}/r") == [[f"l{i}" for i in range(50)]]


def test_log_reports(spark, logs, tmp_path):
    out = f"{tmp_path}/out"
    jobs.store_logs(read_log_lines(spark, f"{logs}/application_*/*"), out, sample_rows=4)
    jobs.write_log_reports(spark, out, sample_rows=4)
    assert texts(f"{out}/level_counts") == [["log_level,count", "INFO,6", "WARN,6"]]
    assert texts(f"{out}/level_report") == [
        [
            "Total log lines processed: 18",
            "Total lines with log levels: 12",
            "Unique log levels found: 2",
            "",
            "Log level distribution:",
            "  INFO :          6 ( 50.00%)",
            "  WARN :          6 ( 50.00%)",
        ]
    ]
    (sample,) = texts(f"{out}/level_sample")
    assert len(sample) == 5
    assert all(line.startswith('"17/01/01 00:0') for line in sample[1:])
    assert texts(f"{out}/timeline")[0][:2] == [
        "application_id,cluster_id,app_number,app_start,app_end",
        "application_10_0007,10,0007,2017-01-01 00:00:01,2017-01-01 00:01:02",
    ]
    assert texts(f"{out}/cluster_summary")[0] == [
        "cluster_id,num_applications,cluster_first_app,cluster_last_app",
        "20,2,2017-01-01 00:00:01,2017-01-01 00:01:03",
        "10,1,2017-01-01 00:00:01,2017-01-01 00:01:02",
    ]
    assert texts(f"{out}/usage_report")[0][2] == "Average applications per cluster: 1.50"

    charts = jobs.chart_tables(spark, out)
    assert [r[:2] for r in rows(charts["applications_per_cluster"])] == [("20", 2), ("10", 1)]
    assert sorted(r[2] for r in rows(charts["durations"])) == [60, 62]
    assert sum(r[4] for r in rows(charts["histogram"])) == 2
    assert charts["density"].count() == 200
    assert sum(r[4] for r in rows(charts["histogram_by_cluster"])) == 3
    assert charts["density_by_cluster"].count() == 200


def test_reports_from_parts_are_reports_of_all(spark, logs, tmp_path):
    whole, parts = f"{tmp_path}/whole", f"{tmp_path}/parts"
    jobs.store_logs(read_log_lines(spark, f"{logs}/application_*/*"), whole, sample_rows=5)
    for name, pattern in (
        ("a", "application_20_*"), ("b", "application_10_*"), ("a", "application_20_*"),
    ):
        lines = read_log_lines(spark, f"{logs}/{pattern}/*")
        jobs.store_logs(lines, parts, part=name, sample_rows=5)
    for out in (whole, parts):
        jobs.write_log_reports(spark, out, sample_rows=5)
    for table in (
        "level_counts", "level_report", "level_sample", "timeline", "cluster_summary",
        "usage_report",
    ):
        assert texts(f"{whole}/{table}") == texts(f"{parts}/{table}"), table


def test_log_reports_of_nothing(spark, tmp_path):
    nothing = spark.createDataFrame([], "value string, file_path string")
    jobs.store_logs(nothing, f"{tmp_path}/out")
    jobs.write_log_reports(spark, f"{tmp_path}/out")
    assert texts(f"{tmp_path}/out/usage_report")[0][2] == "Average applications per cluster: 0.00"


def test_trip_reports(spark, tmp_path):
    trips = spark.range(1000).selectExpr(
        "timestamp_ntz'2021-02-01 00:00:00' + make_dt_interval(cast(id % 10 AS int)) AS tpep_pickup_datetime",
        "2.5D AS trip_distance", "0.5D AS mta_tax", "cast(id AS double) AS fare_amount",
        "0D AS tip_amount", "1.2D AS passenger_count",
    )
    (got,) = rows(jobs.write_trip_reports(trips, 2021, f"{tmp_path}/out"))
    assert got == (10, 1000, 100.0, dt.date(2021, 2, 1), dt.date(2021, 2, 10))
    (table,) = texts(f"{tmp_path}/out/daily_summary")
    assert table[1] == "2021,2,10,100,2.5,0.5,949.0,0.0,2"


def test_sample_of_one_application(spark, logs):
    """A local sample folder is just another path."""
    lines = read_log_lines(spark, f"{logs}/application_10_0007/*")
    assert rows(usage.usage_totals(usage.app_timeline(lines))) == [(1, 1, 1.0)]


def test_reports_need_the_stored_sample(spark, tmp_path):
    lines = log_frame(spark, [(f"{i} INFO a: b", FILE_1) for i in range(30)])
    out = f"{tmp_path}/out"
    jobs.store_logs(lines, out, sample_rows=5)
    with pytest.raises(ValueError, match="25 sample rows"):
        jobs.write_log_reports(spark, out, sample_rows=25)
    jobs.store_logs(lines, out, part="more", sample_rows=5, seed=7)
    with pytest.raises(ValueError, match="seeds"):
        jobs.write_log_reports(spark, out, sample_rows=5)


def test_ordered_parts_and_line_ends(spark, tmp_path):
    """Files hold ranges in order of their names, each with a header; any text comes back."""
    path = f"{tmp_path}/ordered"
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        write_table(spark.range(1000).repartition(7), path, order=[F.desc("id")])
    finally:
        spark.conf.unset(setting)
    parts = [p.read_text().split() for p in sorted((tmp_path / "ordered").glob("part-*.csv"))]
    assert len(parts) > 3 and all(p[0] == "id" for p in parts)
    assert [int(x) for p in parts for x in p[1:]] == list(range(999, -1, -1))
    texts = ['a,"b"', "two\nlines", "back\\", '"', None, "\\\""]
    write_table(spark.createDataFrame([(t,) for t in texts], "t string"), f"{tmp_path}/q", quote_all=True)
    assert {r.t for r in read_result(spark, f"{tmp_path}/q", "t string", multi_line=True).collect()} == set(texts)


def test_months_are_folders(spark, tmp_path):
    frame = spark.createDataFrame([(y, m, y * m) for y in (1, 2) for m in (1, 2, 3)], "year int, month int, x int")
    frame.write.partitionBy("year", "month").parquet(f"{tmp_path}/t")
    found = read_months(spark, f"{tmp_path}/t", 2, [2, 3, 9])
    assert {r.x for r in found.collect()} == {4, 6}
    assert read_months(spark, f"{tmp_path}/t", 5, [1]).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_column_profile(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (2, "x")], "`a.b` int, c string")
    assert [tuple(r) for r in profile_columns(frame).collect()] == [(0, "a.b", "int", 3, 1), (1, "c", "string", 3, 2)]


def test_line_files_equal_those_of_spark(spark, tmp_path):
    """Folders, names and texts as of ``partitionBy``, one file each, and none beside them."""
    made = [("a", "1", "x"), ("a", "1", None), ("a", "2", "caf\u00e9 \u2713"), ("a:=%/b", "1", ""), (None, None, "none"), ("a", "1", "y")] * 30
    lines = spark.createDataFrame(made, "k string, j string, value string").repartition("k", "j").sortWithinPartitions("k", "j")

    def found(root):
        files = [f for f in Path(root).rglob("*") if f.is_file() and not f.name.endswith("crc") and f.name != "_SUCCESS"]
        return {str(f.parent.relative_to(root)): sorted(f.read_text().split("\n")) for f in files}, len(files)

    lines.write.partitionBy("k", "j").text(f"{tmp_path}/spark")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            write_line_files(lines, f"file:{tmp_path}/own{batch}", ["k", "j"])
            assert found(f"{tmp_path}/own{batch}") == found(f"{tmp_path}/spark")
            # No checksum file and nothing else: each would be another process for a file.
            assert sum(f.is_file() for f in (tmp_path / f"own{batch}").rglob("*")) == 4
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    with pytest.raises(FileExistsError):
        write_line_files(lines, f"{tmp_path}/own7", ["k", "j"])


def test_line_files_of_nothing(spark, tmp_path):
    write_line_files(spark.createDataFrame([], "k string, value string"), f"{tmp_path}/none", ["k"])
    assert inventory.list_files(spark, f"{tmp_path}/none").count() == 0
