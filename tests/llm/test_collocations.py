"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywood.llm import collocations as module
from tallywood.llm.collocations import best_cut, collocations, in_order

SHAPE = "doc_id bigint, text string, lang string, key string, f int, own string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, share=80, top=2000):
    f, n = Counter(), Counter()
    for row in rows:
        lang = "und" if row[2] is None else row[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (row[1] or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in found.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= share * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in found.items()
        )
        if not inside:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, k = min((2000000 * a // (left + right), k) for k, (left, right) in enumerate(cuts))
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return sorted(
        (lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, all_found in out.items()
        for i, (score, a, phrase, left, right) in enumerate(sorted(all_found)[:top])
    )


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    stock = ["Of the", "new york city", "once upon a time", "x\x01y z", "x z", "Über ähm", "a\u0000b c", "the the", "big"]
    texts = [None, "", " \t ", ".,;:!?", "one", "a  b\ta b.a b\x0ba b\x0ca b\ra b\na b"]
    for _ in range(200):
        parts = rng.choice(stock, int(rng.integers(1, 40)), p=[0.3] + [0.0875] * 8)
        texts.append("".join(p + str(rng.choice([" ", "  ", "\t", ". ", "\n", ", "], p=[0.7, 0.1, 0.05, 0.05, 0.05, 0.05])) for p in parts))
    texts.append("very long " * 4000)
    made = [(i, t, [None, "en", "en", "en", "de", "und"][i % 6], "k", 1, "x") for i, t in enumerate(texts)]
    return made + [made[20], made[20], (None, "of the of the", "en", None, None, None)]


def as_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("least", [2, 30])
def test_equals_plain_count(spark, rows, least):
    expected = plain(rows, least)
    assert len(expected) > 20
    assert as_rows(collocations(spark.createDataFrame(rows, SHAPE).repartition(6), least=least)) == expected


def test_top_and_share(spark, rows):
    frame = spark.createDataFrame(rows, SHAPE).repartition(3)
    assert as_rows(collocations(frame, least=3, share=50, top=4)) == plain(rows, 3, 50, 4)


def test_full_table_of_bits_only_costs(spark, rows, monkeypatch):
    monkeypatch.setattr(module, "bit_table", lambda marks: np.full(module.TABLE_BITS // 63 + 1, -1, dtype=np.int64))
    assert as_rows(collocations(spark.createDataFrame(rows, SHAPE), least=4, top=None)) == plain(rows, 4, top=10**9)


def test_beginnings_reach_every_part(spark):
    """One first word with far more continuations than a part holds."""
    made = [("en", ["hot"], 10**6, None)]
    made += [("en", ["hot", f"w{i:05d}"], 1000 + i, [i]) for i in range(6000)]
    made += [("en", ["hot", "w03000", f"v{i:05d}"], i, None) for i in range(4000)]
    made += [("en", ["hot", "w03000", "v02000", f"u{i}"], 1, None) for i in range(3000)]
    made += [("de", ["hot"], 7, None), ("de", ["hot", "x"], 5, None)]
    frame = spark.createDataFrame(made, "lang string, key array<string>, f bigint, carried array<bigint>")
    counts = {(lang, tuple(key)): f for lang, key, f, _ in made}
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        ordered = in_order(frame)
        assert ordered.select(F.spark_partition_id()).distinct().count() > 3
        found = ordered.collect()
    finally:
        spark.conf.unset(setting)
    assert len(found) == len(made)
    for row in found:
        assert row.found == [counts[row.lang, tuple(row.key[:j])] for j in range(1, len(row.key))]
        assert row.f == counts[row.lang, tuple(row.key)]


def test_counts_beyond_64_bits_of_product(spark):
    big = 9 * 10**15
    frame = spark.createDataFrame([(["a", "b", "c"], big, [big + 1, big + 2], [big + 5, big + 3])], "words array<string>, f bigint, lefts array<bigint>, rights array<bigint>")
    found = frame.select(best_cut().alias("cut")).first().cut
    expected = min((2000000 * big // (left + right), k, left, right) for k, left, right in [(1, big + 1, big + 3), (2, big + 2, big + 5)])
    assert tuple(found) == expected


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], SHAPE)).count() == 0
