"""What Python workers hold: bounded batches out, and freed memory given back after a task."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallywood.llm import partenum, words

PARTS = 16


class Frame:
    """Stands for a table whose ``mapInArrow`` runs in this process."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, task, schema):
        return list(task(iter(self.batches)))


@pytest.fixture
def frame(monkeypatch):
    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(partenum, "TaskContext", Task)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 5_000, 60)) for _ in range(400)] + [None, "", "few words"]
    return Frame([pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})])


def signatures(batches):
    """All dealt signatures by part, sorted, and the most that one batch holds."""
    found, most = {}, 0
    for batch in batches:
        n = 0
        for row in batch.to_pylist():
            slot, sign = np.frombuffer(row["slot"], dtype=np.uint16), np.frombuffer(row["sign"], dtype=np.uint64)
            mark, size = np.frombuffer(row["mark"], dtype=np.int64), np.frombuffer(row["size"], dtype=np.int32)
            if len(slot):
                assert (np.diff(slot.astype(int)) >= 0).all()
                assert (((sign >> np.uint64(32)) % np.uint64(PARTS)) == row["part"]).all()
                found.setdefault(row["part"], []).extend(zip(slot.tolist(), sign.tolist(), mark.tolist(), size.tolist()))
                n += len(slot)
        most = max(most, n)
    return {part: sorted(rows) for part, rows in found.items()}, most


def test_dealt_batches_are_bounded(frame, monkeypatch):
    common = np.zeros(0, dtype=np.uint64)
    whole, _ = signatures(partenum.dealt(frame, PARTS, 5, 75, common))
    total, largest = sum(map(len, whole.values())), max(map(len, whole.values()))
    assert len(whole) == PARTS
    monkeypatch.setattr(partenum, "BATCH", total // PARTS, raising=False)
    cut, most = signatures(partenum.dealt(frame, PARTS, 5, 75, common))
    assert cut == whole
    assert most <= total // PARTS + largest


def test_workers_give_memory_back(frame, monkeypatch):
    given = []
    monkeypatch.setattr(words, "give_back", lambda: given.append(1), raising=False)
    partenum.dealt(frame, PARTS, 5, 75, np.zeros(0, dtype=np.uint64))
    assert given
    words.powers(10)
    assert list(words.lean(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert len(given) == 2


def test_powers_grow_on_demand(monkeypatch):
    monkeypatch.setattr(words, "_powers", [])
    few = words.powers(10)[0].copy()
    assert len(few) < words.SLICE_BYTES
    up, down = words.powers(200_000)
    assert len(up) >= 200_000 and (up[: len(few)] == few).all()
    assert ((up[:200_000] * down[:200_000]) == 1).all()


def test_driver_gets_packed_numbers(spark):
    """The bit table and the common shingles reach the driver without an object for each of their numbers."""
    n = 100_000
    marks = spark.range(n).selectExpr("shiftrightunsigned(xxhash64(id), 1) as mark").union(spark.sql("select 0L as mark"))
    places = marks.toArrow()["mark"].to_numpy() % (1 << partenum.MARK_BITS)
    common = spark.range(5 * n).selectExpr("id as doc_id", f"concat('a b c d e', id % {n}) as text")
    tracemalloc.start()
    try:
        table = partenum.marked_bits(marks)
        most_of_table = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        shingles = partenum.common_shingles(common, 5, 1)
        most_of_shingles = tracemalloc.get_traced_memory()[1] - table.nbytes
    finally:
        tracemalloc.stop()
    assert max(most_of_table, most_of_shingles) < 16 << 20
    assert table.nbytes == (1 << partenum.MARK_BITS) // 8
    assert (np.flatnonzero(np.unpackbits(table, bitorder="little")) == np.unique(places)).all()
    assert len(shingles) == n and (np.diff(shingles.astype(object)) > 0).all()


def test_held_rows(spark):
    """Marks are told apart by their last 25 bits; the broadcast table has 4 KB for each 32,768 of them."""
    frame = spark.range(0, 3_000).selectExpr("id * 25013 as mark", "id as x")
    marks = frame.where("x % 3 = 0").select("mark")
    found = partenum.held(frame, marks.union(marks), 2_000)
    places = {m % (1 << partenum.MARK_BITS) for m in range(0, 3_000 * 25_013, 3 * 25_013)}
    assert sorted(r["x"] for r in found.collect()) == [x for x in range(3_000) if x * 25_013 % (1 << partenum.MARK_BITS) in places]
    assert found.columns == ["mark", "x"]
    assert partenum.held(frame, marks.where("mark < 0"), 0).count() == 0
    assert partenum.mark_bits(frame).selectExpr("max(octet_length(bits))", "count(*) <= 1024").first()[:] == (4096, True)
