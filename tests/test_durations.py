import datetime as dt
import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest

from tallywood.operators import durations
from tests.test_usage import TIMELINE
from tests.logs import rows

START = dt.datetime(2017, 1, 1)


def timeline(spark, seconds_by_cluster):
    return spark.createDataFrame(
        [
            (f"application_{c}_{i}", c, str(i), START, START + dt.timedelta(seconds=s))
            for c, all_seconds in seconds_by_cluster.items()
            for i, s in enumerate(all_seconds)
        ],
        TIMELINE,
    )


@pytest.fixture(scope="module")
def spans():
    pick = random.Random(3)
    return {
        "1": [int(pick.lognormvariate(6, 2)) for _ in range(400)],
        "2": [10, 20, 30, 30],
        "3": [55, 55],
        "4": [7],
    }


def test_durations_carry_their_cluster_size(spark, spans):
    got = rows(durations.app_durations(timeline(spark, spans)))
    assert Counter(r[1] for r in got) == {c: len(s) for c, s in spans.items()}
    assert all(r[3] == len(spans[r[1]]) for r in got)
    assert sorted(r[2] for r in got if r[1] == "1") == sorted(spans["1"])


def test_top_cluster(spark, spans):
    top = durations.in_top_cluster(timeline(spark, spans))
    assert {r["cluster_id"] for r in top.collect()} == {"1"}
    assert top.count() == 400


def test_top_cluster_of_equals_is_the_first_id(spark):
    top = durations.in_top_cluster(timeline(spark, {"9": [1, 2], "8": [3, 4]}))
    assert {r["cluster_id"] for r in top.collect()} == {"8"}


def test_histogram_agrees_with_numpy(spark, spans):
    got = rows(durations.duration_histogram(timeline(spark, spans), 50))
    for cluster in ("1", "2"):
        heights, edges = np.histogram(spans[cluster], bins=50)
        mine = {r[1]: r for r in got if r[0] == cluster}
        assert {b: r[4] for b, r in mine.items()} == {
            b: int(h) for b, h in enumerate(heights) if h
        }
        for b, r in mine.items():
            assert r[2] == pytest.approx(edges[b])
            assert r[3] == pytest.approx(edges[b + 1])


def test_equal_durations_fill_one_bin(spark, spans):
    got = rows(durations.duration_histogram(timeline(spark, spans), 50))
    assert [r for r in got if r[0] == "3"] == [("3", 0, 55.0, 55.0, 2)]
    assert [r for r in got if r[0] == "4"] == [("4", 0, 7.0, 7.0, 1)]


def test_density_agrees_with_the_formula(spark, spans):
    got = rows(durations.duration_density(timeline(spark, spans), 25))
    assert {r[0] for r in got} == {"1", "2"}
    for cluster in ("1", "2"):
        values = spans[cluster]
        n, low, high = len(values), min(values), max(values)
        width = n**-0.2 * statistics.stdev(values)
        for _, point, at, density in (r for r in got if r[0] == cluster):
            assert at == pytest.approx(low + point * (high - low) / 24)
            expected = sum(math.exp(-(((at - v) / width) ** 2) / 2) for v in values)
            expected /= n * width * math.sqrt(2 * math.pi)
            assert density == pytest.approx(expected, abs=1e-11)


def test_nothing_in_nothing_out(spark):
    nothing = timeline(spark, {})
    assert rows(durations.in_top_cluster(nothing)) == []
    assert rows(durations.duration_histogram(nothing)) == []
    assert rows(durations.duration_density(nothing)) == []
