"""The training-data operators against brute force on small, awkward tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywood.llm import exact_dedup, langid, linededup, lm, mixing, packing, partenum, quality, sharding, warc

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, shard string, mark int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empties, ties, copies, near copies, a hot source, one long text; clashing extra columns."""
    rng = np.random.default_rng(3)
    texts = [None, "", "   \n ", "One", "one", "a b c d", "Über alles ÄÖ", "X\n\nY\n", "12 34 !!"]
    base = sentence(rng, 120)
    for n in range(25):
        cut = base.split()
        for at in rng.integers(0, len(cut), n % 9):
            cut[at] = f"new{n}"
        texts.append(" ".join(cut))
    passage = sentence(rng, 60)
    texts += [f"{sentence(rng, 8)}\n{passage}\n{sentence(rng, 30)}" for _ in range(8)]
    texts += [sentence(rng, int(n)) for n in rng.integers(1, 90, 60)]
    texts += [base, base.upper(), base, sentence(rng, 6000)]
    made = [(i, t, "en" if i % 3 else None, None if i % 7 == 0 else "hot" if i % 2 else f"s{i % 5}", 1, 2, "x", 3) for i, t in enumerate(texts)]
    return made + [made[20], (None, "no id here " * 9, None, "hot", 0, 0, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(5)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(i % 4 > 0), 0) for i, r in enumerate(rows[:60])] + [(None, None, None)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


def as_dicts(frame):
    return [r.asDict() for r in frame.collect()]


def test_empty_tables(spark, nothing):
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for made in (
        sharding.shard_by_bytes(nothing),
        mixing.mix_sources(nothing),
        packing.pack_buckets(nothing),
        exact_dedup.exact_copies(nothing),
        linededup.repeated_lines(nothing),
        quality.quality_rules(nothing, no_labels),
        langid.identify_languages(nothing),
        lm.score_texts(nothing),
        partenum.jaccard_components(nothing),
    ):
        assert made.count() == 0


def test_shards(docs, rows):
    found = as_dicts(sharding.shard_by_bytes(docs, shards=3, rows_per_piece=10))
    assert len(found) == len(rows)
    total = sum(r["size"] for r in found)
    largest = max(r["size"] for r in found)
    by_shard = {s: [r for r in found if r["shard"] == s] for s in range(3)}
    for shard in by_shard.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
        assert abs(sum(r["size"] for r in shard) - total / 3) <= largest
    ids = [r["doc_id"] for s in range(3) for r in sorted(by_shard[s], key=lambda r: r["slot"]) if r["doc_id"] is not None]
    assert ids == sorted(ids)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))


def filled(sizes, share, most, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over


def test_mix(docs, rows):
    found = as_dicts(mixing.mix_sources(docs, least_block=4, rows_per_piece=10))
    again = as_dicts(mixing.mix_sources(docs, least_block=4, rows_per_piece=10))
    key = lambda r: tuple(str(v) for v in r.values())
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert len(found) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    targets = filled(sizes, 1.5, 2.0)
    taken = Counter()
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 4 * 8


def test_mix_of_small_sources(spark):
    """Sources from a fifth of a block to five blocks beside large ones take their targets, at few slots."""
    sizes = {f"big{i}": 20_000 for i in range(3)} | {f"s{i:02}": max(1, int(360 * f)) for i, f in enumerate([0.2, 0.5, 0.9, 1.1, 1.5, 2, 2.3, 3, 4, 5] * 2)}
    made = [(i, " ".join(["w"] * n), s) for i, (s, size) in enumerate(sizes.items()) for n in [7] * (size // 7) + [size % 7]]
    small = spark.createDataFrame(made, "doc_id bigint, text string, source string")
    for slots in (64, 256, 1024):
        taken, targets = Counter(), {}
        for r in as_dicts(mixing.mix_sources(small, slots=slots, rows_per_piece=500)):
            taken[r["source"]] += r["taken"]
            targets[r["source"]] = r["target"]
            assert r["taken"] <= 2 * r["size"]
        assert targets.keys() == sizes.keys()
        for source, target in targets.items():
            assert abs(taken[source] - target) <= max(1, 0.01 * target)


def test_schedule_is_even_at_every_length(spark):
    """Slots run from 0; in every prefix each source has its share of the words, but for a few blocks."""
    sizes = {"big0": 20_000, "big1": 20_000, "mid": 3_000, "s0": 10, "s1": 30, "s2": 75, "s3": 200}
    made = [((False, s), n) for s, n in sizes.items()]
    sources = spark.createDataFrame(made, "source_key struct<missing: boolean, name: string>, source_size bigint")
    targets = mixing.source_targets(sources, (5, 2, 1), 1.5, 2.0)
    share = {r["source_key"]["name"]: r["target"] for r in targets.collect()}
    found = {}
    for golden in (mixing.GOLDEN, 1):
        dealt = sorted(mixing.schedule(targets, 1024, 64, golden).collect(), key=lambda r: r["slot"])
        assert [r["slot"] for r in dealt] == list(range(len(dealt)))
        so_far, most, ranks = Counter(), 0.0, Counter()
        for r in dealt:
            name = r["source_key"]["name"]
            assert r["rank"] == ranks[name]
            ranks[name] += 1
            so_far[name] += r["take"]
            words = sum(so_far.values())
            most = max(most, *(abs(so_far[s] - words * share[s] / sum(share.values())) for s in sizes))
        assert so_far == Counter({s: int(t) for s, t in share.items()})
        found[golden] = (most, [(r["source_key"]["name"], r["block_number"]) for r in dealt])
    assert found[mixing.GOLDEN][0] <= 6 * 64
    assert found[1][0] > 20 * 64  # points in one line from 0 to 1 are no mixture
    assert found[1][1] != found[mixing.GOLDEN][1]


def test_first_slots_follow_the_schedule(docs):
    """``first_slot`` is there where words are taken, and another constant deals other slots but the same amounts."""
    found = {g: as_dicts(mixing.mix_sources(docs, least_block=4, rows_per_piece=10, golden=g)) for g in (mixing.GOLDEN, 1)}
    for made in found.values():
        assert all((r["first_slot"] is None) == (r["taken"] == 0) for r in made)
    taken, slots = ([Counter((r["doc_id"], r["size"], r[c]) for r in made) for made in found.values()] for c in ("taken", "first_slot"))
    assert taken[0] == taken[1]
    assert slots[0] != slots[1]


def test_packing(docs, rows):
    found = as_dicts(packing.pack_buckets(docs, buckets=4, budget=300, rows_per_piece=10))
    assert len(found) == len(rows)
    batches = {}
    for r in found:
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
        assert r["padding"] == r["bucket_tokens"] - r["n_tokens"] >= 0
    for batch in batches.values():
        assert sorted(r["slot"] for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * batch[0]["bucket_tokens"] <= 300


def least_padded(lengths, counts, buckets):
    """Tokens with padding at best, by trying all last ranges."""
    best = [0.0] + [math.inf] * len(lengths)
    for _ in range(buckets):
        best = [0.0] + [
            min([best[j]] + [best[i] + lengths[j - 1] * sum(counts[i:j]) for i in range(j)]) for j in range(1, len(lengths) + 1)
        ]
    return best[-1]


@pytest.mark.parametrize("fine_bits", [3, 16])
def test_padding_is_least(docs, fine_bits):
    """Whatever shares a cell of the histogram, buckets end at their longest texts; exact lengths give least padding."""
    found = as_dicts(packing.pack_buckets(docs, buckets=5, fine_bits=fine_bits))
    longest = {}
    for r in found:
        longest[r["bucket"]] = max(longest.get(r["bucket"], 0), r["n_tokens"])
    assert all(r["bucket_tokens"] == longest[r["bucket"]] for r in found)
    seen = sorted(Counter(r["n_tokens"] for r in found).items())
    least = least_padded(*zip(*seen), 5)
    total = sum(r["bucket_tokens"] for r in found)
    assert total == least if fine_bits == 16 else least <= total <= 1.25 * least


def test_boundaries_of_random_lengths():
    rng = np.random.default_rng(5)
    for n in range(1, 40):
        lengths = sorted({int(x) for x in rng.integers(1, 90, n)})
        counts = [int(c) for c in rng.integers(1, 6, len(lengths))]
        ends = packing.best_boundaries(lengths, counts, 6)
        padded = sum(c * min(e for e in ends if e >= w) for w, c in zip(lengths, counts))
        assert len(ends) <= 6 and padded == least_padded(lengths, counts, 6)


def test_best_boundaries():
    import itertools

    lengths, counts = np.array([1.0, 2, 4, 7, 9, 12]), np.array([5.0, 1, 7, 2, 2, 1])

    def cost(ends):
        return sum(c * min(e for e in ends if e >= n) for n, c in zip(lengths, counts))

    for k in (1, 2, 3, 6, 9):
        best = min(cost((*e, 12)) for e in itertools.combinations(lengths[:-1], min(k, 6) - 1))
        assert cost(packing.best_boundaries(lengths, counts, k)) == best


def test_exact_copies(docs, rows):
    import hashlib

    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(LOWER), []).append(r[0])
    want = Counter()
    for body, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(body.encode()).hexdigest())] += 1
    for first in (4, 64):
        assert Counter(tuple(r) for r in exact_dedup.exact_copies(docs, first_bytes=first, growth=3).collect()) == want


def test_quality_statistics(docs, labels, rows):
    found = {r["doc_id"]: r for r in as_dicts(quality.quality_rules(docs, labels))}
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        lines, seen, again = (text or "").split("\n"), set(), 0
        for line in lines:
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        r = found[doc_id]
        got = tuple(r[n] for n in quality.STATS)
        assert got == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_languages(spark):
    rng = np.random.default_rng(1)
    kinds = {"aa": ["the", "and", "that", "with", "wither"], "bb": ["und", "ße", "über", "nicht", "zu"], "cc": ["que", "ñar", "los", "ción", "para"]}
    made = []
    for i in range(400):
        lang = list(kinds)[i % 3]
        made.append((i, " ".join(rng.choice(kinds[lang], rng.integers(3, 200))), lang))
    made += [(900, None, "aa"), (901, "12 !", "bb"), (None, "und über", None)]
    found = as_dicts(langid.identify_languages(spark.createDataFrame(made, "doc_id bigint, text string, lang string"), per_language=60))
    truth = {i: lang for i, _, lang in made}
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(made)
    for r in found:
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    assert by_id[900]["lang_pred"] == by_id[901]["lang_pred"] == "und"
    held = [r for r in found if r["held_out"] and r["lang_pred"] != "und" and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_language_model(docs, rows):
    """Counts by hand; the score with the same weights by hand."""
    source = docs.select("doc_id", "text", F.lit(1).alias("role"))
    roles = {}
    for r in rows:
        rest = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5
        roles[r[0]] = {1: 0, 0: 2}.get(rest, 1)
    mapped = F.create_map(*[F.lit(x) for i, v in roles.items() if i is not None for x in (i, v)])
    source = source.withColumn("role", F.coalesce(mapped[F.col("doc_id")], F.lit(roles[None])))
    model = lm.count_words(source, 3)
    lm.learn_weights(source, model, 3)
    assert np.allclose(model.weights.sum(axis=1), 1)
    found = {r["doc_id"]: r for r in as_dicts(lm.score_texts(docs, parts=3))}
    tokens = [(r[0], [*words(r[1]), None]) for r in rows]
    trained = [t for i, t in tokens if roles[i]]
    c = Counter(w for t in trained for w in t)
    pairs = Counter(p for t in trained for p in zip(["<", *t[:-1]], t))
    n, v = sum(c.values()), len(c)
    _, buckets = model.contexts(1)
    for i, t in tokens:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        total = 0.0
        for h, w in zip(["<", *t[:-1]], t):
            seen = len(trained) if h == "<" else c[h]
            bucket = int(min(max(-math.log2(seen / n), 0), lm.RARE_BUCKET - 1)) if seen else lm.RARE_BUCKET
            a = model.weights[bucket]
            total += math.log10(a[0] * (pairs[h, w] / seen if seen else 0) + a[1] * c[w] / n + a[2] / (v + 1))
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] == pytest.approx(total)


@pytest.mark.parametrize("rare", [1, 30, 200])
def test_language_model_with_rare_contexts(docs, monkeypatch, rare):
    """What is sent to every task, down to no word at all, changes no result: every word is a context."""
    source = docs.select("doc_id", "text", (F.col("n_chars") + F.length("text") % 2).cast("bigint").alias("role")).na.fill(1)

    def fitted():
        model = lm.count_words(source, 3)
        lm.learn_weights(source, model, 3)
        return model, sorted(as_dicts(lm.score_tokens(source, model, 3)), key=str), sorted(as_dicts(lm.score_texts(docs, parts=3)), key=str)

    plain, *want = fitted()
    monkeypatch.setattr(lm, "RARE", rare)
    model, *found = fitted()
    assert len(model.words) < len(plain.words) / 4 and len(model.pairs) < len(plain.pairs) / 4
    assert np.allclose(model.weights, plain.weights)
    for rows_found, rows_wanted in zip(found, want):
        assert len(rows_found) == len(rows_wanted)
        for f, w in zip(sorted(rows_found, key=lambda r: (str(r["doc_id"]), r["score"])), sorted(rows_wanted, key=lambda r: (str(r["doc_id"]), r["score"]))):
            assert f == pytest.approx(w, nan_ok=True)


def test_similarity_join(docs, rows, monkeypatch):
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    names = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            names[root(i)] = min(names.get(root(i), r[0]), r[0])
    want = Counter((r[0], len(s), names.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets)))
    assert Counter(tuple(r) for r in partenum.jaccard_components(docs, parts=3).collect()) == want
    # The same with many pieces to a task.
    monkeypatch.setattr(partenum, "PIECE_BYTES", 500)
    assert Counter(tuple(r) for r in partenum.jaccard_components(docs, parts=3).collect()) == want


def test_similarity_join_in_rounds(docs, monkeypatch):
    want = Counter(tuple(r) for r in partenum.jaccard_components(docs, parts=3).collect())
    monkeypatch.setattr(partenum, "HUBS", 2)
    assert Counter(tuple(r) for r in partenum.jaccard_components(docs, parts=3).collect()) == want


def test_signatures_of_all_slots_are_sent_together(spark):
    """As many rows as parts, and one for the documents, however many sizes of sets there are."""
    made = [(i, " ".join(f"w{i}x{j}" for j in range(5 + i))) for i in range(0, 300, 3)]
    made = spark.createDataFrame(made, "doc_id bigint, text string").coalesce(1)
    sent = partenum.dealt(made, 4, 5, 75, np.zeros(0, dtype=np.uint64)).collect()
    slots = {s for r in sent for s in np.frombuffer(r["slot"], dtype=np.uint16)}
    assert len(slots) > 10 and len(sent) == 4 + 1


def test_small_links_make_few_files(spark):
    links = spark.range(1, 200).select(F.col("id").alias("high"), (F.col("id") - F.col("id") % 7).alias("low")).where("high > low")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = partenum.components(links)
        assert {(r["node"], r["component"]) for r in found.collect()} == {(i, i - i % 7) for i in range(200) if i < 199 or i % 7}
        assert len(found.inputFiles()) == 1
    finally:
        spark.conf.set(name, before)


def test_packed_numbers_are_compressed():
    draw = np.random.default_rng(5)
    for values in (np.minimum(draw.zipf(1.3, 20_000), 60_000).astype(np.uint64), draw.integers(0, 9, 40).astype(np.int64), np.zeros(900, dtype=np.uint32)):
        packed = lm.planes(values)
        assert (lm.from_planes(pa.scalar(packed, pa.binary()), values.dtype.type) == values).all()
        assert len(packed) < 1.3 * len(values) + 2
    word = np.arange(5, dtype=np.uint64) * 7
    model = lm.Model(word, np.array([2, 0, 1, 4, 3]), np.zeros((2, 5)), np.zeros(2), np.zeros(2), 5)
    assert model.number(np.array([7, 8, 28], dtype=np.uint64)).tolist() == [0, -1, 3]


def test_sketches_never_differ_more_than_sets():
    draw = np.random.default_rng(4)
    for size, other in ((0, 3), (5, 5), (40, 60), (700, 900), (5000, 100)):
        shared = draw.integers(0, 1 << 63, 50, dtype=np.uint64)
        sets = [np.unique(np.concatenate([shared, draw.integers(0, 1 << 63, n, dtype=np.uint64)])) for n in (size, other)]
        rows = np.repeat([0, 1], [len(s) for s in sets])
        one, two = partenum.sketches(rows, np.concatenate(sets), 2)
        assert sum(int(x).bit_count() for x in (one ^ two).view(np.uint64)) <= len(np.setxor1d(*sets))
    same = partenum.sketches(np.repeat([0, 1], len(shared)), np.concatenate([shared, shared]), 2)
    assert (same[0] == same[1]).all()


def test_line_runs(spark):
    run = "\n".join(f"line {i} of the run that is copied" for i in range(9))
    made = [(1, f"start\n{run}\nend"), (2, f"other\n\n{run}"), (3, None), (4, "short\nshort"), (5, run), (5, run)]
    found = as_dicts(linededup.repeated_lines(spark.createDataFrame(made, "doc_id bigint, text string"), min_words=20))
    got = sorted((r["doc_id"], r["n_lines"], r["n_deleted"], tuple(r["deleted"])) for r in found)
    assert got == [
        (1, 11, 0, ()), (2, 10, 9, tuple(range(2, 11))), (3, 0, 0, ()), (4, 2, 0, ()),
        (5, 9, 9, tuple(range(9))), (5, 9, 9, tuple(range(9))),
    ]


def test_suffix_array(spark):
    """Order, common lines and levels against sorted suffixes of random stretches, with ties."""
    rng = np.random.default_rng(11)
    texts = [list(rng.integers(1, 3, int(n))) for n in rng.integers(1, 14, 25)] + [[1] * 30, [1, 2] * 12, [7, 8, 9] * 6]
    texts += [texts[-1], texts[3], texts[3]]
    gaps = [set(rng.integers(0, len(t), len(t) // 6)) if i % 2 else set() for i, t in enumerate(texts)]
    lines = [(i, n, int(v)) for i, t in enumerate(texts) for n, v in enumerate(t) if n not in gaps[i]]
    frame = spark.createDataFrame(lines, "row bigint, n int, name bigint").repartition(4)
    levels = linededup.suffix_levels(frame, 100, rows_per_piece=7)
    common = {r["rank"]: r["common"] for r in linededup.common_prefixes(levels).collect()}
    found = sorted(as_dicts(levels[-1]), key=lambda r: r["rank"])

    def suffix(r):
        end = min([g for g in gaps[r["row"]] if g > r["n"]], default=len(texts[r["row"]]))
        return texts[r["row"]][r["n"] : end]

    assert {(r["row"], r["n"]) for r in found} == {(i, n) for i, n, _ in lines}
    for at, (one, two) in enumerate(zip(found, found[1:]), 1):
        a, b = suffix(one), suffix(two)
        shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert two["left"] == len(b)
        assert (one["rank"] == two["rank"]) if a == b else (a < b and two["rank"] == at and common[at] == shared)
    assert common[0] == 0
    for k, level in enumerate(levels):
        begun = Counter((r["rank"], tuple(suffix(r)[: 1 << k])) for r in as_dicts(level))
        assert len({rank for rank, _ in begun}) == len(begun) == len({b for _, b in begun})


def test_line_runs_against_all_runs(spark):
    """Deleted lines against every run of enough words with an earlier copy; ties, NULL ids, clashing columns."""
    rng = np.random.default_rng(5)
    pool = ["a", "a b", "c d e", "f g h i", "j", "k l", "  ", "m n o p q"]
    texts = ["\n".join(pool[i] for i in rng.integers(0, len(pool), int(n))) for n in rng.integers(0, 14, 60)]
    texts += [None, texts[8], texts[8], "a b\n" * 40, "\n".join(f"u{i} v" for i in range(300)) + "\n" + texts[9]]
    texts += [texts[-1]]
    made = [(None if i % 11 == 5 else 1000 - 7 * i if i % 2 else 7 * i, t, 1, 2, "x") for i, t in enumerate(texts)]
    shape = "doc_id bigint, text string, row int, rank int, name string"
    found = as_dicts(linededup.repeated_lines(spark.createDataFrame(made, shape), min_words=7, rows_per_piece=9))

    order = sorted(range(len(made)), key=lambda i: (made[i][0] is not None, made[i][0] or 0, i))
    seen, want = {}, []
    for place, i in enumerate(order):
        lines = [(at, line) for at, line in enumerate((made[i][1] or "").split("\n")) if words(line)]
        gone = set()
        for start in range(len(lines)):
            count = 0
            for end in range(start, len(lines)):
                count += len(words(lines[end][1]))
                run = tuple(line for _, line in lines[start : end + 1])
                if count >= 7 and seen.setdefault(run, (place, start)) != (place, start):
                    gone |= {at for at, _ in lines[start : end + 1]}
        want.append((str(made[i][0]), len(lines), len(gone), tuple(sorted(gone))))
    got = [(str(r["doc_id"]), r["n_lines"], r["n_deleted"], tuple(r["deleted"])) for r in found]
    assert sorted(got) == sorted(want)


def test_archives(spark, tmp_path):
    """A round trip with segments dealt over many files, in any order."""
    big = "é" * 20_000 + "\r\n\r\nWARC/1.1\r\n"
    made = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u", ""), (5, "v", big), (6, "w", big), (7, "w", big + "!"), (None, "n", "x"), (2, "http://b", "x")]
    pages = spark.createDataFrame(made, "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), segment_bytes=700, records_per_file=5)
    found = as_dicts(warc.read_archives(spark, str(tmp_path / "w")))
    html = {p: (h or "").encode() for p, _, h in made}
    want = {1: None, 2: 1, 3: None, 4: 3, 5: None, 6: 5, 7: None, None: 1}
    assert len(found) == len(made)
    for r in found:
        body = html[r["page_id"]]
        assert r["complete"] and r["refers_to"] == want[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), warc.sha1_base32(body))
        assert r["payload"] == (None if r["record_type"] == "revisit" else body)


def test_broken_framing():
    assert warc.unchunked(warc.chunked(b"abc" * 50, 7)) == b"abc" * 50
    for body in (b"", b"zz\r\n", b"5\r\nab", b"2\r\nabXX0\r\n\r\n"):
        assert warc.unchunked(body) is None
