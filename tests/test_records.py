import random

import pytest

from tallywood.operators import records
from tallywood.operators.records import assign_records, multiline_records, record_pieces
from tallywood.plans import jobs
from tallywood.sources.log_files import read_positioned_log_lines
from tests.logs import rows

STAMP = "17/03/29 10:04:41 INFO a: "
SCHEMA = "file_path string, block bigint, pos bigint, value string"


def by_hand(lines, lines_per_part):
    """Rows of lines given in order per file."""
    found, open_record, number = {}, {}, {}
    for file, _, _, value in lines:
        number[file] = line = number.get(file, 0) + 1
        if value.startswith("17/"):
            open_record[file] = line
        record = open_record.get(file, line)
        found.setdefault((file, record, (line - record) // lines_per_part), []).append(value)
    return sorted((*key, len(v), "\n".join(v)) for key, v in found.items())


def made_lines(seed, block_lines):
    pick = random.Random(seed)
    lines = []
    for file in ("f1", "f2", "f3"):
        for pos in range(pick.randrange(40, 80)):
            stamped = pick.random() < 0.3 and not (file == "f3" and pos < 30)
            lines.append((file, pos // block_lines, pos, f"{STAMP if stamped else '  at '}{pos}"))
    return lines


@pytest.mark.parametrize("lines_per_part", [1, 2, 5, 10_000])
@pytest.mark.parametrize("block_lines", [1, 3, 10, 1000])
def test_records_whatever_the_blocks(spark, block_lines, lines_per_part):
    lines = made_lines(11, block_lines)
    shuffled = lines[:]
    random.Random(1).shuffle(shuffled)
    got = rows(multiline_records(spark.createDataFrame(shuffled, SCHEMA), lines_per_part))
    assert sorted(got) == by_hand(lines, lines_per_part)


def test_one_record_with_nearly_all_lines(spark):
    """No row holds more than a part of it, and no line is lost."""
    lines = spark.range(20_000).repartition(8).selectExpr(
        "'f' AS file_path", "id div 1000 AS block", "id AS pos",
        f"if(id = 10, '{STAMP}', concat('line ', id)) AS value",
    )
    got = sorted(rows(multiline_records(lines, 300)))
    assert [r[1:4] for r in got[:10]] == [(i + 1, 0, 1) for i in range(10)]
    assert [r[1:4] for r in got[10:]] == [(11, p, min(300, 19_990 - 300 * p)) for p in range(67)]
    text = "\n".join(r[4] for r in got[10:])
    assert text == "\n".join([STAMP] + [f"line {i}" for i in range(11, 20_000)])


def test_lines_keep_their_columns(spark):
    lines = spark.createDataFrame([("f", 0, 0, STAMP), ("f", 0, 1, "x")], SCHEMA)
    got = assign_records(lines)
    assert set(got.columns) == {"file_path", "block", "pos", "value", "record"}
    assert {(r["pos"], r["record"]) for r in got.collect()} == {(0, 0), (1, 0)}


def test_records_of_files_read_in_many_pieces(spark, tmp_path):
    """The same rows however the scan cuts the files, with a record over many cuts."""
    pick = random.Random(2)
    wanted = []
    for name in ("one.log", "two.log"):
        lines = []
        for i in range(400):
            frames = 3_000 if i == 200 else pick.choice([0, 0, 1, 3, 9])
            lines += [f"{STAMP}{name} {i}", *(f"    at frame {i}.{j}" for j in range(frames))]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        wanted += [(name, 0, 0, line) for line in lines]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    blocks = []
    try:
        for size in ("3000", "20000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = read_positioned_log_lines(spark, str(tmp_path))
            blocks.append(lines.select("file_path", "block").distinct().count())
            got = [(r[0].rsplit("/", 1)[1], *r[1:]) for r in rows(multiline_records(lines, 100))]
            assert sorted(got) == by_hand(wanted, 100)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert blocks[0] > blocks[1] > blocks[2] == 2


def test_stored_records_equal_any_cut(spark, tmp_path):
    """Records put together at the scan, for small and large pieces, batches and parts."""
    pick = random.Random(5)
    wanted = []
    logs = tmp_path / "logs"
    logs.mkdir()
    for name in ("one.log", "two.log", "empty.log", "none.log"):
        lines = []
        for i in range(0 if name == "empty.log" else 300):
            frames = 2_500 if i == 150 else pick.choice([0, 0, 1, 3, 9])
            head = "" if name == "none.log" or (name == "two.log" and i < 9) else STAMP
            lines += [f"{head}{name} {i}", *(f"    at frame {i}.{j}" if j % 7 else "" for j in range(frames))]
        (logs / name).write_text("\n".join(lines) + "\n" if lines else "")
        wanted += [(name, 0, 0, line) for line in lines]
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    old = [spark.conf.get(s) for s in settings]
    try:
        for size, batch, part in (("3000", "10000", 100), ("20000", "70", 100), ("128m", "7", 3), ("9000", "1", 1), ("128m", "10000", 10_000)):
            for setting, value in zip(settings, (size, batch)):
                spark.conf.set(setting, value)
            out = str(tmp_path / f"out-{size}-{batch}-{part}")
            jobs.store_records(read_positioned_log_lines(spark, str(logs)), out, part)
            got = rows(jobs.read_records(spark, out, part))
            assert sorted((r[0].rsplit("/", 1)[1], *r[1:]) for r in got) == by_hand(wanted, part)
    finally:
        for setting, value in zip(settings, old):
            spark.conf.set(setting, value)


def stored_records(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for name in ("a.log", "b.log"):
        (logs / name).write_text("".join(f"{STAMP}{i}\n  more\n" for i in range(50)))
    jobs.store_records(read_positioned_log_lines(spark, str(logs)), str(tmp_path / "out"))
    return jobs.read_records(spark, str(tmp_path / "out"))


def test_text_inside_pieces_does_not_move(spark, tmp_path):
    plan = stored_records(spark, tmp_path)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    # Besides the sizes of pieces, only the parts that were taken apart line by line are exchanged.
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert all("record" in x or "file_path" in x for x in exchanges) and "Generate posexplode" in plan
    pieces = record_pieces(read_positioned_log_lines(spark, str(tmp_path / "logs")))
    assert "Exchange" not in pieces._jdf.queryExecution().executedPlan().toString()


def test_many_pieces_are_joined_by_sorting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "PIECES_TO_SEND", 0)
    made = stored_records(spark, tmp_path)
    assert "SortMergeJoin" in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[1:] for r in rows(made)) == sorted((2 * i + 1, 0, 2, f"{STAMP}{i}\n  more") for i in range(50) for _ in range(2))


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty.log").write_text("")
    jobs.store_records(read_positioned_log_lines(spark, str(tmp_path / "empty.log")), str(tmp_path / "out"))
    assert rows(jobs.read_records(spark, str(tmp_path / "out"))) == []


def test_a_task_takes_many_small_files(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for i in range(600):
        (logs / f"{i}.log").write_text(f"{STAMP}{i}\n  more\n")
    setting = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(setting)
    jobs.store_records(read_positioned_log_lines(spark, str(logs)), str(tmp_path / "out"))
    assert spark.conf.get(setting) == before
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= 9
    assert sorted(r.text for r in jobs.read_records(spark, str(tmp_path / "out")).collect()) == sorted(f"{STAMP}{i}\n  more" for i in range(600))
