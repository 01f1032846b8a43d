import pytest

from tallywood.operators import levels
from tallywood.operators.parsing import profile_files
from tests.logs import FILE_1, FILE_2, PARSED, log_frame, rows, sample_log


@pytest.fixture
def lines(spark):
    return sample_log(spark)


@pytest.fixture
def empty(spark):
    return log_frame(spark, [])


def test_counts(lines):
    got = rows(levels.level_counts(levels.tally_levels(lines)))
    assert got == [
        ("INFO", 2, 40.0), ("DEBUG", 1, 20.0), ("ERROR", 1, 20.0), ("WARN", 1, 20.0),
    ]


def test_totals(lines, empty):
    assert rows(levels.log_totals(levels.tally_levels(lines))) == [(8, 5, 4)]
    assert rows(levels.log_totals(levels.tally_levels(empty))) == [(0, 0, 0)]


def test_counts_of_nothing(empty):
    assert rows(levels.level_counts(levels.tally_levels(empty))) == []


def test_tally_from_files_is_the_tally(lines):
    direct = sorted(rows(levels.tally_levels(lines)), key=str)
    stored = sorted(rows(levels.tally_of_files(profile_files(lines))), key=str)
    assert direct == stored


def test_report_has_the_published_form(spark):
    tally = spark.createDataFrame(
        [
            ("INFO", 27389482, 27389482),
            ("WARN", 9595, 9595),
            ("ERROR", 11259, 11259),
            (None, 5826268, 0),
        ],
        "log_level string, num_lines bigint, count bigint",
    )
    report = levels.level_report(tally).orderBy("line_no")
    assert [r.line for r in report.collect()] == [
        "Total log lines processed: 33236604",
        "Total lines with log levels: 27410336",
        "Unique log levels found: 3",
        "",
        "Log level distribution:",
        "  INFO :   27389482 ( 99.92%)",
        "  ERROR:      11259 (  0.04%)",
        "  WARN :       9595 (  0.04%)",
    ]


def test_report_of_nothing(empty):
    got = [r.line for r in levels.level_report(levels.tally_levels(empty)).collect()]
    assert got[:3] == [
        "Total log lines processed: 0",
        "Total lines with log levels: 0",
        "Unique log levels found: 0",
    ]
    assert len(got) == 5


def test_sample_is_repeatable_and_whole(lines):
    first = rows(levels.sample_lines(lines, 3, seed=7))
    again = rows(levels.sample_lines(lines.repartition(5), 3, seed=7))
    assert first == again and len(first) == 3
    everything = sorted(rows(levels.sample_lines(lines, 100, seed=7)))
    assert everything == sorted((line, level) for line, level, _ in PARSED if level)


def test_samples_differ_by_seed(spark):
    lines = log_frame(spark, [(f"INFO a: {i}", FILE_1) for i in range(500)])
    drawn = [tuple(rows(levels.sample_lines(lines, 10, seed))) for seed in (1, 2, None, None)]
    assert len(set(drawn)) == 4


def test_occurrences_count_every_hit(lines):
    # "INFORMATION" and the second word of a line count as well.
    assert dict(rows(levels.level_occurrences(lines))) == {
        "INFO": 3, "ERROR": 2, "WARN": 1, "DEBUG": 1,
    }


def test_error_lines(spark, lines):
    by_level = [r.value for r in levels.error_lines(lines).collect()]
    literal = [r.value for r in levels.error_lines(lines, literal=True).collect()]
    assert by_level == [PARSED[1][0]]
    assert literal == [PARSED[1][0], PARSED[2][0]]


def test_a_file_with_most_lines_is_counted_whole(spark):
    hot = spark.range(60_000).selectExpr(
        "concat('17/03/29 10:00:00 ', if(id % 3 = 0, 'WARN', 'INFO'), ' a: b') AS value",
        f"'{FILE_1}' AS file_path",
    )
    cold = log_frame(spark, [("ERROR x", FILE_2)] * 100)
    tally = levels.tally_levels(hot.repartition(16).union(cold))
    assert {(r["log_level"], r["count"]) for r in tally.collect()} == {
        ("WARN", 20_000), ("INFO", 40_000), ("ERROR", 100),
    }
