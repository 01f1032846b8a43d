"""What the plans must look like: these are the properties that hold at scale."""

import re

import pytest

from tallywood.operators import appstats, daily, durations, levels, messages, records, usage
from tallywood.operators.parsing import parse_lines, profile_files
from tallywood.plans.checked import QUERIES
from tallywood.sources.log_files import read_log_lines, read_positioned_log_lines

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def lines(spark, tmp_path):
    folder = tmp_path / "application_20_0001"
    folder.mkdir()
    (folder / "container_20_0001_01_000001.log").write_text(
        "17/01/01 00:00:00 INFO a: b\n17/01/01 00:00:09 INFO a: b\n"
    )
    return read_log_lines(spark, f"{tmp_path}/application_*/*")


def physical(df):
    """The plan before it runs, without the adaptive wrapper's copies."""
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The final adaptive plan after the query ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def below_scan_shuffle(plan):
    """The stage that reads the lines: everything under the lowest exchange."""
    return plan[plan.rindex("Exchange ") :]


def test_no_python_in_any_plan(spark):
    for name, query in QUERIES.items():
        if name != "log_text_scan":
            plan = physical(query(spark, FOLDER))
            assert not re.search(r"EvalPython|PythonUDF|InPandas|InArrow|ExistingRDD", plan), name


def test_no_cross_join_in_any_plan(spark):
    for name, query in QUERIES.items():
        if name != "log_text_scan":
            plan = physical(query(spark, FOLDER))
            assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), name


@pytest.mark.parametrize(
    "build",
    [
        lambda lines: levels.tally_levels(lines),
        lambda lines: levels.level_occurrences(lines),
        lambda lines: profile_files(lines),
        lambda lines: usage.app_timeline(lines),
        lambda lines: usage.container_roles(lines),
        lambda lines: usage.error_rates(lines),
        lambda lines: appstats.component_counts(lines),
        lambda lines: appstats.requested_resources(lines),
        lambda lines: appstats.app_python_times(lines),
        lambda lines: appstats.cached_bytes(lines),
        lambda lines: appstats.host_containers(lines),
    ],
)
def test_lines_are_reduced_before_the_first_shuffle(lines, build):
    stage = below_scan_shuffle(physical(build(lines)))
    assert "partial_" in stage
    assert "Sort" not in stage


def test_path_patterns_run_per_file_not_per_line(lines):
    for df in (usage.app_timeline(lines), usage.container_roles(lines), usage.error_rates(lines)):
        assert "application_" not in re.sub(r"Location:.*", "", below_scan_shuffle(physical(df)))


def test_only_the_wanted_patterns_run(lines):
    stage = physical(parse_lines(lines).select("log_level"))
    assert stage.count("regexp_extract") == 1


def test_messages_do_not_shuffle(lines):
    for df in (
        messages.resource_requests(lines),
        messages.task_events(lines),
        messages.memory_blocks(lines),
        levels.error_lines(lines),
    ):
        plan = physical(df)
        assert "Exchange" not in plan
        # The byte search comes before the pattern.
        assert plan.index("Contains(") < plan.index("RLIKE(") if "RLIKE(" in plan else True


def test_sampling_and_top_lists_do_not_sort(spark, lines):
    for df in (
        levels.sample_lines(lines),
        levels.sample_lines(lines, seed=None),
        appstats.top_components(lines),
        QUERIES["largest_applications"](spark, FOLDER),
    ):
        plan = physical(df)
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_year_range_and_columns_reach_the_scan(spark):
    trips = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    columns = daily.TripColumns(
        "l_shipdate", "l_quantity", "l_tax", "l_extendedprice", "l_discount", "l_quantity"
    )
    plan = physical(daily.daily_summary(trips, 1998, columns))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan
    assert "LessThan(l_shipdate,1999-01-01T00:00)" in plan
    assert re.search(
        r"ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,"
        r"l_tax:double,l_shipdate:timestamp_ntz>",
        plan,
    )
    totals = physical(daily.trip_totals(trips, 1998, columns))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in totals


@pytest.mark.parametrize(
    "build",
    [
        lambda t: usage.usage_report(t),
        lambda t: durations.app_durations(t),
        lambda t: durations.app_durations(durations.in_top_cluster(t)),
        lambda t: durations.duration_histogram(t),
        lambda t: durations.duration_histogram(durations.in_top_cluster(t)),
        lambda t: durations.duration_density(t),
        lambda t: durations.duration_density(durations.in_top_cluster(t)),
    ],
)
def test_logs_are_scanned_once(lines, build):
    """However many branches a result has, they share the timeline's shuffle."""
    plan = ran(build(usage.app_timeline(lines)))
    assert plan.count("FileScan text") == 1
    assert "ReusedExchange" in plan
    # The timeline's own order is dropped where nobody needs it.
    assert "app_start" not in "".join(re.findall(r"rangepartitioning\(.*", plan))


def test_no_sort_below_an_aggregate(lines):
    plan = physical(usage.cluster_summary(usage.app_timeline(lines)))
    assert plan.count("rangepartitioning") == 1
    assert plan.index("rangepartitioning") < plan.index("HashAggregate")


def test_task_lines_meet_without_a_join(lines):
    tasks = appstats.task_times(lines)
    plan = physical(tasks)
    assert "Join" not in plan
    assert re.search(r"hashpartitioning\(application_id#\d+, stage#\d+L, tid#\d+L", plan)


def test_hosts_are_deduplicated_before_they_meet(lines):
    plan = physical(appstats.host_containers(lines))
    assert re.search(r"hashpartitioning\(host#\d+, container_id#\d+", plan)


def test_records_are_split_by_block(spark, lines, tmp_path):
    positioned = read_positioned_log_lines(spark, f"{tmp_path}/application_*/*")
    df = records.multiline_records(positioned)
    plan = physical(df)
    assert re.search(r"hashpartitioning\(file_path#\d+, block#\d+L", plan)
    assert "SortAggregate" not in plan
    # Parts inside a block are grouped without moving text again.
    inside = plan[: plan.index("Exchange")]
    assert "collect_list" in inside
    final = ran(df)
    assert final.count("FileScan text") == 1
    assert "ReusedExchange" in final


def test_one_file_metadata_column_is_read(lines):
    plan = physical(usage.app_timeline(lines))
    assert re.search(r"FileScan text \[value#\d+,file_path#\d+\]", plan)
