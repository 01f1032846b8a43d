"""Periodic runs against a plain search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from tallywood.llm.periodic import op11_periodic_runs, periodic_runs

SHAPE = "doc_id bigint, text string, start int, period string, row_key int, body string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                stretch = words[i : i + length]
                if not any(stretch[:-s] == stretch[s:] for s in range(1, q)):
                    runs.append((i, length, q))
            i = j + 1
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def texts():
    rng = np.random.default_rng(11)
    made = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "Ab ab " * 9, "é ü " * 4, "x\x0by\x0cx\ry " * 5]
    for _ in range(60):  # few words, so that runs of all kinds come up, also inside each other
        made.append(" ".join(rng.choice(["a", "b"], int(rng.integers(5, 60)))))
    for _ in range(60):  # powers of random stretches between random words
        out = []
        for _ in range(int(rng.integers(1, 5))):
            out += [f"w{i}" for i in rng.integers(0, 50, int(rng.integers(0, 20)))]
            stretch = [f"v{i}" for i in rng.integers(0, 3, int(rng.integers(1, 40)))]
            out += (stretch * 9)[: len(stretch) * int(rng.integers(3, 8)) + int(rng.integers(0, len(stretch)))]
        made.append("  ".join(out))
    made += ["same " * 3000, " ".join(f"p{i % 331}" for i in range(2600)), " ".join(f"p{i % 64 % 63}" for i in range(2000))]
    return made


@pytest.fixture(scope="module")
def rows():
    made = [(i, t, 1, "x", 2, "y") for i, t in enumerate(texts())]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in made) > 5
    return made + [made[40], made[3], (None, "u v " * 20, 0, None, None, None), (None, None, 0, None, None, None)]


def as_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_equals_plain_search(spark, rows):
    expected = sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert sum(r[1] > 1 for r in expected) > 20
    for parts in (1, 7):
        assert as_rows(periodic_runs(spark.createDataFrame(rows, SHAPE).repartition(parts))) == expected


def test_every_short_text_of_two_words(spark):
    made = [(None, " ".join("ab"[(i >> k) & 1] for k in range(13))) for i in range(1 << 13)]
    frame = spark.createDataFrame(made, "doc_id bigint, text string")
    assert as_rows(periodic_runs(frame)) == sorted((plain(*r) for r in made), key=repr)


def test_planted_runs_of_all_sizes(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rng = np.random.default_rng(5)
    made = [(i, " ".join(f"w{x}" for x in rng.integers(0, 900, int(rng.integers(1, 1500))))) for i in ids]
    frame = spark.createDataFrame(made, "doc_id bigint, text string")
    assert as_rows(periodic_runs(frame)) == sorted((plain(*r) for r in made), key=repr)


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], SHAPE)).count() == 0


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: plain(r.doc_id, r.text) for r in docs if len(WORD.findall(r.text or "")) <= 1500}
    found = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, folder).collect()}
    assert len(found) == len(docs) and len(short) > len(docs) // 2
    assert {i: found[i] for i in short} == short
