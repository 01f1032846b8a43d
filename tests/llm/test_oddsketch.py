"""Near copies by odd sketches against a comparison of all pairs."""

import re

import numpy as np
import pytest

from tallywood.llm import oddsketch, partenum
from tallywood.llm.oddsketch import near_copies, odd_sketches, op12_odd_sketches, samples
from tallywood.llm.words import mix

SHAPE = "doc_id bigint, text string, mark string, size int, sign string, component int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 2]) for i in range(len(words) - 1)) or frozenset([tuple(words)])


def plain(rows, least=80):
    sets = [shingles(r[1]) for r in rows]
    different = list(dict.fromkeys(s for s in sets if s))
    parent = {s: s for s in different}

    def top(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    holders = {}
    for number, s in enumerate(different):
        for shingle in s:
            holders.setdefault(shingle, []).append(number)
    common = {}
    for found in holders.values():
        for i, a in enumerate(found):
            for b in found[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    for (a, b), both in common.items():
        if 100 * both >= least * (len(different[a]) + len(different[b]) - both):
            parent[top(different[a])] = top(different[b])
    ids = {}
    for row, s in zip(rows, sets):
        if s and row[0] is not None:
            ids[top(s)] = min(row[0], ids.get(top(s), row[0]))
    out = []
    for row, s in zip(rows, sets):
        component = ids.get(top(s)) if s else row[0]
        out.append((row[0], len(s), component, row[0] == component))
    return sorted(out, key=repr)


def as_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def changed(rng, words, n):
    words = list(words)
    for at in rng.integers(0, len(words), n):
        words[at] = f"new{rng.integers(0, 10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    texts = [None, "", " \n", "One", "one", "a b", "A b", "a b c", "a b c d e f", "a b c d e", "a b c d e f g", "x\ty\nz"]
    for family in range(5):  # similarities around 80 percent, chains of links
        base = [f"f{family}w{i}" for i in rng.integers(0, 300, 40 + 40 * family)]
        texts += [changed(rng, base, int(n)) for n in rng.integers(0, 4 + 3 * family, 40)]
    texts += [" ".join(f"w{i}" for i in rng.integers(0, 60, int(n))) for n in rng.integers(1, 80, 80)]
    texts += [texts[20], texts[20].upper(), " ".join(f"w{i % 5003}" for i in range(30000))]
    made = [(i, t, "m", 3, "s", 4) for i, t in enumerate(texts)]
    return made + [made[30], (None, texts[25], None, None, None, None), (None, "no id", None, 0, None, None), (None, None, None, 0, None, None)]


def test_equals_all_pairs(spark, rows):
    expected = plain(rows)
    assert 20 < sum(not r[3] for r in expected) < len(expected) - 20
    assert as_rows(near_copies(spark.createDataFrame(rows, SHAPE).repartition(7))) == expected


def test_rounds_alone_find_all_links(spark, rows, monkeypatch):
    """Few sets a time, and no first comparison."""
    monkeypatch.setattr(oddsketch, "HUBS", 1)
    monkeypatch.setattr(oddsketch, "MORE", 6)
    monkeypatch.setattr(oddsketch, "PASSES", 1)
    best = oddsketch._best_hubs
    monkeypatch.setattr(oddsketch, "_best_hubs", lambda candidates: best(candidates).where("false"))
    assert as_rows(near_copies(spark.createDataFrame(rows, SHAPE))) == plain(rows)


def test_sketches_are_joined_once(spark, rows, monkeypatch):
    """What is left for a later round keeps its sketches, and results stay."""
    kept, real = [], oddsketch.stored

    def spy(frame, label):
        kept.extend([frame.columns] * (label == "odd-still"))
        return real(frame, label)

    monkeypatch.setattr(oddsketch, "stored", spy)
    assert as_rows(near_copies(spark.createDataFrame(rows, SHAPE))) == plain(rows)
    assert kept and all({*oddsketch.WORDS, *oddsketch.FULL} <= {*columns} for columns in kept)


def test_sketches_estimate_similarity_and_keep_links():
    rng = np.random.default_rng(4)
    for alike in (0.8, 0.85, 0.95):
        for n in (5, 20, 400):
            both = round(n * alike)
            if both < alike * n:
                both += 1
            far = []
            for _ in range(60):
                pool = mix(rng.integers(0, 2**62, 2 * n).astype(np.uint64))
                alone = n - both  # of the union
                one = np.sort(pool[: both + alone // 2])
                other = np.sort(np.concatenate([pool[:both], pool[both + alone // 2 : n]]))
                sketches = odd_sketches(samples(np.concatenate([one, other]), np.array([0, len(one)])))
                far.append(sum(int(x).bit_count() for x in (sketches[0] ^ sketches[1]).view(np.uint64)))
            assert max(far) <= oddsketch.most_apart(80)
            differ = -oddsketch.BITS / 4 * np.log(1 - 2 * np.mean(far) / oddsketch.BITS)
            assert abs(1 - differ / oddsketch.SAMPLES - both / n) < 0.02


def test_full_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(6)
    for n in (3, 50, 3000):
        pool = mix(rng.integers(0, 2**62, 2 * n).astype(np.uint64))
        one, other = pool[:n], pool[n // 3 : n + n // 3]
        rows = np.repeat([0, 1], [len(one), len(other)])
        a, b = oddsketch.full_sketches(rows, np.concatenate([one, other]), 2)
        assert sum(int(x).bit_count() for x in (a ^ b).view(np.uint64)) <= len(np.setxor1d(one, other))


def test_comparison_sends_only_the_sets_of_its_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    marks = [int(m) for m in rng.integers(0, 2**62, 3000)]
    packed = [np.sort(rng.integers(0, 2**62, 20).astype(np.uint64)) for _ in marks]
    packed[1] = np.sort(np.concatenate([packed[0][:19], packed[1][:1]]))  # 19 of 21 shingles shared
    sets = spark.createDataFrame([(m, bytearray(s.tobytes())) for m, s in zip(marks, packed)], "mark bigint, shingles binary")
    near, far = sorted(marks[:2]), sorted(marks[2:4])
    sent, real = [], partenum.held

    def spy(frame, of, n):
        sent.append({r.mark for r in real(frame, of, n).collect()})
        return real(frame, of, n)

    monkeypatch.setattr(partenum, "held", spy)
    pairs = spark.createDataFrame([near, far], "low bigint, high bigint")
    assert [tuple(r) for r in partenum.linked(pairs, sets, 80).collect()] == [tuple(near)]
    highs, lows = sent
    assert {near[1], far[1]} <= highs and {near[0], far[0]} <= lows and len(highs) + len(lows) < 20
    assert partenum.linked(pairs.limit(0), sets, 80).count() == 0


def test_bits_keep_every_wanted_mark(spark):
    marks = spark.range(0, 2**63 - 1, 2**63 // 5000).withColumnRenamed("id", "mark")
    wanted = marks.where("mark % 3 = 0")
    kept = partenum.held(marks, wanted, wanted.count())
    assert kept.columns == ["mark"] and wanted.exceptAll(kept).isEmpty()
    assert kept.count() < 1.2 * wanted.count()


def test_empty_table(spark):
    assert near_copies(spark.createDataFrame([], SHAPE)).count() == 0


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(op12_odd_sketches(spark, folder)) == plain(docs)
