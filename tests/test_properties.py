"""Properties that must hold for any log, on generated lines and layouts."""

import datetime as dt
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallywood.operators import levels, usage
from tallywood.operators.parsing import parse_lines, profile_files
from tallywood.operators.records import multiline_records
from tests.logs import log_frame, rows

few = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

pieces = st.sampled_from(
    [
        "INFO", "WARN", "ERROR", "DEBUG", "info", "ERR", "INFORMATION", " ", "  ", "\t", ":", "a.B",
        "17/03/29 10:04:41", "17/02/30 10:04:41", "99/12/31 23:59:59", "7/3/29 1:0:0",
        "17/03/29  10:04:41", "١٧/03/29 10:04:41", "é", "日", "|", '"', ",", "x: y",
    ]
)
texts = st.lists(pieces, max_size=8).map("".join)
apps = st.sampled_from(["10_0001", "10_0002", "20_0001", None])
logs = st.lists(st.tuples(texts, apps, st.integers(1, 3)), max_size=60)


def path(app, container):
    if app is None:
        return f"file:/var/log/syslog.{container}"
    return f"file:/logs/application_{app}/container_{app}_01_{container:06d}.log"


def frame(spark, log):
    return log_frame(spark, [(text, path(app, c)) for text, app, c in log])


def group(pattern, text, index=1):
    found = re.search(pattern, text, re.ASCII)
    return found.group(index) if found else None


def level_of(text):
    return group(r"(INFO|WARN|ERROR|DEBUG)", text)


def time_of(text):
    stamp = group(r"^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})", text)
    try:
        return stamp and dt.datetime.strptime("20" + stamp, "%Y/%m/%d %H:%M:%S")
    except ValueError:
        return None


@few
@given(logs)
def test_parse(spark, log):
    parsed = parse_lines(frame(spark, log)).select("value", "log_level", "ts", "component")
    want = [
        (
            text, level_of(text), time_of(text),
            group(r"(INFO|WARN|ERROR|DEBUG)\s+([^:]+):", text, 2),
        )
        for text, _, _ in log
    ]
    assert Counter(rows(parsed)) == Counter(want)


@few
@given(logs)
def test_counts_add_up(spark, log):
    lines = frame(spark, log)
    tally = levels.tally_levels(lines)
    counted = {r["log_level"]: r["count"] for r in levels.level_counts(tally).collect()}
    assert counted == Counter(level_of(t) for t, _, _ in log if level_of(t))
    assert rows(levels.log_totals(tally)) == [(len(log), sum(counted.values()), len(counted))]
    stored = levels.tally_of_files(profile_files(lines))
    assert Counter(rows(stored)) == Counter(rows(tally))
    hits = dict(rows(levels.level_occurrences(lines)))
    assert hits == Counter(
        hit for t, _, _ in log for hit in re.findall("INFO|WARN|ERROR|DEBUG", t)
    )


@few
@given(logs)
def test_timeline_and_summary(spark, log):
    timeline = usage.app_timeline(frame(spark, log))
    spans = {}
    for text, app, _ in log:
        if app and time_of(text):
            spans.setdefault(app, []).append(time_of(text))
    got = rows(timeline)
    assert {r[0]: r[3:] for r in got} == {
        f"application_{a}": (min(t), max(t)) for a, t in spans.items()
    }
    assert [r[3] for r in got] == sorted(r[3] for r in got)
    summary = rows(usage.cluster_summary(timeline))
    assert {r[0]: r[1] for r in summary} == Counter(a.split("_")[0] for a in spans)


@few
@given(st.lists(st.booleans(), max_size=40), st.integers(1, 6), st.integers(1, 4))
def test_records_lose_no_line(spark, stamped, block_lines, lines_per_part):
    made = [
        ("f", i // block_lines, i, ("17/03/29 10:04:41 " if head else "  ") + str(i))
        for i, head in enumerate(stamped)
    ]
    lines = spark.createDataFrame(made, "file_path string, block bigint, pos bigint, value string")
    got = sorted(multiline_records(lines, lines_per_part).collect(), key=lambda r: (r["record"], r["part"]))
    assert "\n".join(r["text"] for r in got) == "\n".join(m[3] for m in made)
    assert sum(r["num_lines"] for r in got) == len(made)
    assert all(r["num_lines"] <= lines_per_part for r in got)
    assert {r["record"] for r in got} >= {i + 1 for i, head in enumerate(stamped) if head}
