import pytest

from tallywood.operators import appstats, messages
from tests.logs import APP, FILE_1, FILE_2, log_frame, rows

# Own lines in the known formats.
LINES = [
    ("17/03/29 10:04:43 INFO YarnAllocator: Will request 12 executor containers, each with 3 cores and 9216 MB memory including 1024 MB overhead", FILE_1),
    ("17/03/29 10:04:44 INFO YarnAllocator: Will request 2 executor containers, each with 1 cores and 1024 MB memory", FILE_1),
    ("17/03/29 10:04:45 INFO YarnAllocator: Container request (host: Any, capability: <memory:9216, vCores:3>)", FILE_1),
    ("17/03/29 10:04:46 INFO YarnAllocator: Will request many containers", FILE_1),
    ("17/03/29 10:11:10 INFO executor.Executor: Running task 21.0 in stage 4.0 (TID 37)", FILE_2),
    ("17/03/29 10:11:13 INFO executor.Executor: Finished task 21.0 in stage 4.0 (TID 37). 1873 bytes result sent to driver", FILE_2),
    ("17/03/29 10:11:11 INFO executor.Executor: Running task 22.1 in stage 4.0 (TID 38)", FILE_2),
    ("17/03/29 10:11:10 INFO rdd.HadoopRDD: Input split: hdfs://store.example:8020/data/in/part-7.txt:524288+131072", FILE_2),
    ("17/03/29 10:11:13 INFO python.PythonRunner: Times: total = 960, boot = 300, init = 60, finish = 600", FILE_2),
    ("17/03/29 10:11:14 INFO python.PythonRunner: Times: total = 40, boot = -18, init = 22, finish = 0", FILE_2),
    ("17/03/29 10:11:14 INFO storage.MemoryStore: MemoryStore started with capacity 6.5 GB", FILE_2),
    ("17/03/29 10:11:14 INFO storage.MemoryStore: Block broadcast_1 stored as bytes in memory (estimated size 2.5 KB, free 6.5 GB)", FILE_2),
    ("17/03/29 10:11:15 INFO storage.MemoryStore: Block rdd_2_3 stored as bytes in memory (estimated size 7.0 B, free 1.0 MB)", FILE_2),
    ("17/03/29 10:11:14 INFO broadcast.TorrentBroadcast: Started reading broadcast variable 3", FILE_2),
    ("17/03/29 10:11:16 INFO x: on mesos-slave-05 and mesos-slave-7:8041, mesos-master-1", FILE_1),
    ("17/03/29 10:11:16 INFO x: mesos-slave-7", FILE_2),
]


@pytest.fixture
def lines(spark):
    return log_frame(spark, LINES)


def values(df):
    """Message columns after application, container and time."""
    return [r[3:] for r in rows(df)]


def test_requests(lines):
    assert values(messages.resource_requests(lines)) == [
        (12, 3, 9216, 1024), (2, 1, 1024, None),
    ]
    assert values(messages.container_requests(lines)) == [("Any", 9216, 3)]
    assert rows(appstats.requested_resources(lines)) == [
        (APP, 2, 14, 38, 12 * 9216 + 2048, 3, 9216, 1024)
    ]


def test_origin_of_a_message(lines):
    first = messages.resource_requests(lines).first()
    assert first["application_id"] == APP
    assert first["container_id"] == "container_1512345678901_0007_01_000001"
    assert str(first["ts"]) == "2017-03-29 10:04:43"


def test_tasks(lines):
    assert values(messages.task_events(lines)) == [
        ("Running", 21, 0, 4, 0, 37, None),
        ("Finished", 21, 0, 4, 0, 37, 1873),
        ("Running", 22, 1, 4, 0, 38, None),
    ]
    tasks = appstats.task_times(lines)
    got = [(r["stage"], r["tid"], r["result_bytes"], r["out_of_order"], r["seconds"]) for r in tasks.collect()]
    assert sorted(got) == [(4, 37, 1873, False, 3), (4, 38, None, False, None)]
    assert rows(appstats.app_task_times(tasks)) == [(APP, 2, 1, 0, 1, 3.0, 3, 1873)]


def test_tasks_seen_once_or_out_of_order_stay(spark):
    lines = log_frame(spark, [
        ("17/03/29 10:00:09 INFO a: Running task 0.0 in stage 1.0 (TID 1)", FILE_2),
        ("17/03/29 10:00:05 INFO a: Finished task 0.0 in stage 1.0 (TID 1). 7 bytes result sent to driver", FILE_2),
        ("17/03/29 10:00:05 INFO a: Finished task 1.0 in stage 1.0 (TID 2). 9 bytes result sent to driver", FILE_2),
    ])
    tasks = appstats.task_times(lines)
    got = [(r["tid"], r["task_start"] is None, r["out_of_order"], r["seconds"]) for r in tasks.collect()]
    assert sorted(got) == [(1, False, True, None), (2, True, False, None)]
    assert rows(appstats.app_task_times(tasks)) == [(APP, 2, 0, 1, 0, None, None, 16)]
    assert rows(appstats.stage_skew(tasks)) == [(APP, 1, 2, 0, 1, 0, None, None, None, None)]


def test_python_times(lines):
    assert values(messages.python_times(lines)) == [(960, 300, 60, 600), (40, -18, 22, 0)]
    assert rows(appstats.app_python_times(lines)) == [(APP, 2, 500.0, 141.0, 41.0, 300.0)]


def test_storage(lines):
    assert values(messages.input_splits(lines)) == [
        ("hdfs://store.example:8020/data/in/part-7.txt", 524288, 131072)
    ]
    gigabytes = round(6.5 * 1024**3)
    assert values(messages.memory_capacities(lines)) == [(gigabytes,)]
    assert values(messages.memory_blocks(lines)) == [
        ("broadcast_1", 2560, gigabytes), ("rdd_2_3", 7, 1024**2),
    ]
    assert rows(appstats.cached_bytes(lines)) == [(APP, 2, 2567, 2560, 1024**2)]
    assert values(messages.broadcast_reads(lines)) == [(3,)]


def test_hosts(lines):
    assert sorted(rows(appstats.host_containers(lines))) == [
        ("mesos-slave-05", 1, 1), ("mesos-slave-7", 2, 2),
    ]


def test_numbers_too_long_are_null(spark):
    lines = log_frame(spark, [("Started reading broadcast variable " + "9" * 30, FILE_1)])
    assert values(messages.broadcast_reads(lines)) == [(None,)]


def test_stage_skew(spark):
    """One stage holds nearly all tasks; its percentiles stay exact."""
    hot = spark.range(20_000).repartition(8).selectExpr(
        f"'{APP}' AS application_id", "1L AS stage", "id AS tid",
        "if(id < 19900, id % 50 + 1, 400L) AS seconds", "1L AS result_bytes",
        "timestamp_ntz'2017-03-29' AS task_end", "false AS out_of_order",
    )
    cold = spark.createDataFrame(
        [(APP, 2, 1, 0, 1), (APP, 2, 2, 0, 1)],
        "application_id string, stage bigint, tid bigint, seconds bigint, result_bytes bigint",
    ).selectExpr("*", "timestamp_ntz'2017-03-29' AS task_end", "false AS out_of_order")
    got = {r["stage"]: r for r in appstats.stage_skew(hot.union(cold)).collect()}
    seconds = sorted([i % 50 + 1 for i in range(19_900)] + [400] * 100)
    assert got[1]["median_seconds"] == seconds[9_999]
    assert got[1]["p95_seconds"] == seconds[18_999]
    assert got[1]["skew"] == 400 / seconds[9_999]
    assert (got[2]["median_seconds"], got[2]["skew"]) == (0, None)


def test_components_are_ranked(spark):
    lines = log_frame(
        spark,
        [("INFO a: 1", FILE_1)] * 3 + [("INFO b: 1", FILE_1)] * 3 + [("x", FILE_1)] * 4
        + [("WARN c: 1", FILE_1)],
    )
    assert rows(appstats.component_counts(lines)) == [(None, 4), ("a", 3), ("b", 3), ("c", 1)]
    assert rows(appstats.top_components(lines, rows=2)) == [(None, 4), ("a", 3)]


def test_all_messages_from_one_scan(spark):
    """Every reader's rows come from the one table, also of lines with two messages or a control character."""
    texts = [
        "17/03/29 10:04:41 INFO a: Will request 2 executor containers, each with 3 cores and 512 MB memory",
        "17/03/29 10:04:41 INFO a: Will request 2 executor containers, each with 3 cores and 512 MB memory including 64 MB overhead",
        "17/03/29 10:04:41 INFO a: Container request (host: h\u0001x, capability: <memory:99, vCores:7>)",
        "17/03/29 10:04:41 INFO a: Finished task 1.0 in stage 2.1 (TID 9). 77 bytes result sent to driver",
        "Running task 1.0 in stage 2.1 (TID 99999999999999999999) and Started reading broadcast variable 4",
        "Times: total = -1, boot = 2, init = -3, finish = 4 Input split: hdfs://a/b:7+8",
        "Block rdd_1_2 stored as bytes in memory (estimated size 1.5 KB, free 2.0 GB)",
        "MemoryStore started with capacity 3.5 MB",
        "Will request nothing task \u0001 Times: total = x\u0001\u0001\u0001\u0001\u0001",
        "Finished task 3.0 in stage 4.0 (TID 5)\u0001 12 bytes result sent to driver",
        "\u0001\u0001",
        "plain",
    ]
    lines = log_frame(spark, [(t, FILE_1) for t in texts])
    readers = {
        "resource_request": messages.resource_requests,
        "container_request": messages.container_requests,
        "task_event": messages.task_events,
        "python_times": messages.python_times,
        "input_split": messages.input_splits,
        "memory_block": messages.memory_blocks,
        "memory_capacity": messages.memory_capacities,
        "broadcast_read": messages.broadcast_reads,
    }
    found = messages.all_messages(lines)
    for kind, reader in readers.items():
        assert rows(messages.messages_of(found, kind)) == rows(reader(lines)) != []
    assert found.count() == 11
    assert [r[3:] for r in rows(messages.container_requests(lines))] == [("h\u0001x", 99, 7)]
    assert [r[3:] for r in rows(messages.task_events(lines))] == [
        ("Finished", 1, 0, 2, 1, 9, 77), ("Running", 1, 0, 2, 1, None, None), ("Finished", 3, 0, 4, 0, 5, 12),
    ]
    assert [r[3:] for r in rows(messages.resource_requests(lines))] == [(2, 3, 512, None), (2, 3, 512, 64)]
