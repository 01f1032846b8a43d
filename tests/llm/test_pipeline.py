"""All stages of the pipeline against brute force, with NULL and repeated ids."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywood.llm import mixing, quality, rows, tables

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, `a.b` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    found = words(text)
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(11)
    texts = []
    for n in range(40):
        base = [f"w{i}" for i in rng.integers(0, 500, 25 + 4 * n)]
        near = list(base)
        near[n % 25] = "other"
        texts += [" ".join(base), " ".join(near), " ".join(base).upper()][: 1 + n % 3]
    texts += ["few words", "", None, "w1 " * 60]
    found = [(i, t, "en", None if i % 9 == 0 else "hot" if i % 2 else f"s{i % 4}", 1, "x") for i, t in enumerate(texts)]
    by_hand = [(None, t, "en", s, 1, "y") for t in (texts[3], texts[4], texts[10]) for s in ("hot", None)]
    alone = [" ".join(f"u{n}x{i}" for i in range(30)) for n in range(3)]
    found += [(1000 + n, t, "en", "hot", 1, "x") for n, t in enumerate(alone)]
    by_hand += [(None, alone[0], "en", "hot", 1, "z"), (2000, alone[1], "en", "hot", 1, "z"), (2000, alone[1], "en", "hot", 1, "z")]
    return found + by_hand + [found[7], found[7]]


@pytest.fixture(scope="module")
def folder(spark, made, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(made, SHAPE).repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(i % 4 > 0), 0) for i, r in enumerate(made[:60])]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def after(spark, folder, stage, docs):
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns
    return [tuple(r) for r in out.collect()]


def test_quality_stage(spark, folder, made):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = quality.quality_rules(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    by_id = {r["doc_id"]: r["kept"] for r in judged.where("doc_id is not null").collect() if r["doc_id"] != 2000}
    by_text = {r[1]: by_id[r[0]] for r in made if r[0] in by_id}
    assert len({*by_text.values()}) == 2
    expected = Counter(r for r in made if by_text[r[1]])
    assert Counter(after(spark, folder, corpus_pipeline.quality, docs)) == expected


def test_exact_stage(spark, folder, made):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    best = {}
    for r in made:
        key = (r[1] or "").translate(LOWER)
        best[key] = max(best.get(key, -1), -1 if r[0] is None else r[0])
    found = after(spark, folder, corpus_pipeline.exact_dedup, docs)
    assert Counter(((r[1] or "").translate(LOWER), -1 if r[0] is None else r[0]) for r in found) == Counter(best.items())
    assert not Counter(found) - Counter(made)


def test_near_stage(spark, folder, made):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sets = [shingles(r[1]) for r in made]
    parent = list(range(len(made)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i, r in enumerate(made):
        groups[top(i)].append((r[0] is None, r[0] or 0))
    found = after(spark, folder, corpus_pipeline.near_dedup, docs)
    assert Counter((r[0] is None, r[0] or 0) for r in found) == Counter(min(g) for g in groups.values())
    kept = [shingles(r[1]) for r in found]
    assert not any(a and b and 100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(kept) for b in kept[:i])


def test_mixing_stage(spark, folder, made):
    """Ids that are apart: as often as the operator says; rows without id count each."""
    numbered = [(i, *r[1:]) for i, r in enumerate(made)]
    docs = tables.stored(spark.createDataFrame(numbered, SHAPE).repartition(3), "numbered")
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix_sources(docs).collect()}
    times = {i: int(t / n + 0.5) if n else 1 for i, (t, n) in taken.items()}
    assert max(times.values()) == 2 and min(times.values()) == 0
    expected = Counter({r: times[r[0]] for r in numbered if times[r[0]]})
    assert Counter(after(spark, folder, corpus_pipeline.mixing, docs)) == expected

    nameless = spark.createDataFrame([(None, *r[1:]) for r in made], SHAPE).repartition(3)
    found = after(spark, folder, corpus_pipeline.mixing, nameless)
    targets = {r["source"]: r["target"] for r in mixing.mix_sources(nameless).collect()}
    longest = max(len(words(r[1])) for r in made)
    for source, target in targets.items():
        assert abs(sum(len(words(r[1])) for r in found if r[3] == source) - target) <= longest
    assert max(Counter(found).values()) > 1


def test_whole_run(spark, folder, made):
    """Stage by stage is the same as the run, and every row gets a place of its own."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, folder), "stage")
    placed = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in placed) == Counter(r["doc_id"] for r in docs.collect())
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in placed}) == len(placed) > 20


def test_empty_tables(spark, folder):
    nothing = spark.createDataFrame([], SHAPE)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).collect() == []


@pytest.mark.parametrize("most", [0, rows.MOST_BITMAPS])
def test_picked_rows(spark, tmp_path, monkeypatch, most):
    """Rows as often as said, with broadcast bitmaps and beyond; numbers don't move with columns or pieces."""
    monkeypatch.setattr(rows, "BITS", 64)
    spark.range(1000).selectExpr("id", "id % 7 as v", "id as `a.b`").repartition(5).write.parquet(f"{tmp_path}/t")
    docs = rows.numbered_rows(spark.read.parquet(f"{tmp_path}/t"))
    assert sorted(r[0] for r in docs.select(rows.ROW).collect()) == list(range(1000))
    marks = tables.stored(rows.bitmaps(docs.select(F.col(rows.ROW).alias("row"), (F.col("v") % 3).cast("int").alias("times"))), "marks")
    picked = rows.pick_rows(docs, marks, most)
    assert picked.columns == ["id", "v", "a.b"]
    assert Counter(r[0] for r in picked.collect()) == Counter({i: i % 7 % 3 for i in range(1000) if i % 7 % 3})
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan and "Exchange hashpartitioning(__chunk" not in plan) == bool(most)


def test_finished_tables_go(spark):
    def build():
        kept.append(tables.stored(spark.range(3), "first").inputFiles()[0])
        return spark.range(2)

    kept = []
    result = tables.stored_alone(spark, build, "second")
    path = spark._jvm.org.apache.hadoop.fs.Path(kept[0])
    assert result.count() == 2
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
