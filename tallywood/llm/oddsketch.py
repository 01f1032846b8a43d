"""Near copies by MinHash bands, with odd sketches of the samples to check candidates.

An odd sketch has a bit for each residue of a hash; every MinHash sample of a
set turns one of them.  The XOR of two sketches so counts, in its one bits, in
how many samples two sets differ, most precisely where they differ in few.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.components import components
from tallywood.llm.partenum import _blocks, held, linked
from tallywood.llm.tables import stored
from tallywood.llm.words import U, mix

SIZE, LEAST = 2, 80  # words of a shingle; similarity in percent
#: Sets of 80 % similarity miss each other in all bands with a chance below 3e-10.
BANDS, ROWS = 56, 5
SAMPLES, BITS, SIGMAS = 560, 1024, 5.5
HUBS, MORE = 16, 16  # sets of a band compared with the others of it in the first round; so many times more in each next
TABLE_BITS = 1 << 25
PASSES = 2  # comparisons of each set with one other before all candidates are compared
WORDS = [f"w{i}" for i in range(BITS // 64)]
FULL = [f"v{i}" for i in range(BITS // 64)]
FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=U)) | U(1)
SAMPLED = ", ".join(["doc_id bigint, mark bigint, size bigint, signs array<bigint>", *[f"{w} bigint" for w in WORDS + FULL]])


def set_marks(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """A mark for each row's set; equal sets have equal marks."""
    sizes = np.bincount(rows, minlength=n)
    ends = np.cumsum(sizes)
    sums = np.concatenate([np.zeros(1, dtype=U), np.cumsum(mix(hashes))])
    return (mix(sums[ends] - sums[ends - sizes] + sizes.astype(U)) >> U(1)).astype(np.int64)


def samples(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """``SAMPLES`` rows of the least hash of each set; set i begins at ``firsts[i]`` and is not empty."""
    least = np.empty((SAMPLES, len(firsts)), dtype=U)
    for row, factor in zip(least, FACTORS):
        np.minimum.reduceat(hashes * factor, firsts, out=row)
    return least


def band_signs(least: np.ndarray) -> np.ndarray:
    """One value for each set and band, of the samples in the band and its number."""
    signs = np.zeros((BANDS, least.shape[1]), dtype=U)
    for band in range(BANDS):
        signs[band] = band + 1
        for row in least[band * ROWS : (band + 1) * ROWS]:
            signs[band] = mix(signs[band] ^ row)
    return signs.T.astype(U).view(np.int64) if signs.size else np.zeros((0, BANDS), dtype=np.int64)


def odd_sketches(least: np.ndarray) -> np.ndarray:
    """The parity of the samples at each of ``BITS`` bits, as words."""
    sets = np.arange(least.shape[1])
    words = np.zeros((least.shape[1], BITS // 64), dtype=U)
    for number, row in enumerate(least):
        place = mix(row + U(number)) >> U(64 - (BITS - 1).bit_length())
        words[sets, (place >> U(6)).astype(np.int64)] ^= U(1) << (place & U(63))
    return words.view(np.int64)


def full_sketches(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The same of whole sets: the XOR of two never has more one bits than shingles that only one set has."""
    words = np.zeros(n * len(FULL), dtype=U)
    place = mix(hashes + U(1)) >> U(64 - (BITS - 1).bit_length())
    np.bitwise_xor.at(words, rows * len(FULL) + (place >> U(6)).astype(np.int64), U(1) << (place & U(63)))
    return words.reshape(n, len(FULL)).view(np.int64)


def most_apart(least: int) -> int:
    """One bits in the XOR of two sketches that sets as similar as ``least`` percent do not pass.

    Mean plus ``SIGMAS`` deviations of them, from the samples and from folding.
    """
    alike = least / 100
    turned = 2 * SAMPLES * (1 - alike)
    fade, fade_two = (1 - 2 / BITS) ** turned, (1 - 4 / BITS) ** turned
    of_samples = SAMPLES * alike * (1 - alike) * (2 * fade) ** 2
    of_folding = BITS / 4 * (1 - fade**2) + BITS * (BITS - 1) / 4 * (fade_two - fade**2)
    return math.ceil(BITS / 2 * (1 - fade) + SIGMAS * math.sqrt(of_samples + of_folding))


def sampled(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, mark, size`` of each document, and ``mark, size, signs`` and sketch of each task's different sets."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        names = ["doc_id", "mark", "size", "signs", *WORDS, *FULL]
        for ids, rows, hashes, sizes, _ in _blocks(batches, size):
            marks, n = set_marks(rows, hashes, len(sizes)), len(sizes)
            none = [pa.nulls(n, kind), *[pa.nulls(n, pa.int64())] * len(WORDS + FULL)]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(marks), pa.array(sizes, pa.int64()), *none], names=names)
            new = np.zeros(n, dtype=bool)
            new[np.unique(marks, return_index=True)[1]] = True
            new &= sizes > 0
            if not new.any():
                continue
            firsts = np.cumsum(np.concatenate([[0], sizes[new]]))[:-1]
            of_set = new[rows]
            least, m = samples(hashes[of_set], firsts), int(new.sum())
            whole = full_sketches((np.cumsum(new) - 1)[rows[of_set]], hashes[of_set], m)
            signs, words = band_signs(least), np.hstack([odd_sketches(least), whole])
            lists = pa.ListArray.from_arrays(np.arange(0, (m + 1) * BANDS, BANDS, dtype=np.int32), signs.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.array(marks[new]), pa.array(sizes[new], pa.int64()), lists, *[pa.array(w) for w in words.T]],
                names=names,
            )

    return docs.mapInArrow(sample, SAMPLED)


def bit_table(marks: DataFrame) -> np.ndarray:
    """``TABLE_BITS`` bits with those of ``marks`` set, 63 to a number; its size never grows."""
    place = F.col("mark") % TABLE_BITS
    words = (
        marks.select(F.floor(place / 63).alias("word"), F.expr(f"shiftleft(1L, cast(mark % {TABLE_BITS} % 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()  # bounded by the table
    )
    table = np.zeros(TABLE_BITS // 63 + 1, dtype=np.int64)
    table[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return table


def full_sets(docs: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """``mark, shingles`` of the sets in ``marks``, as packed sorted hashes."""
    table = bit_table(marks)  # false hits only cost

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, hashes, sizes, _ in _blocks(batches, size):
            own = set_marks(rows, hashes, len(sizes))
            new = np.zeros(len(own), dtype=bool)
            new[np.unique(own, return_index=True)[1]] = True
            place = own % TABLE_BITS
            new &= ((table[place // 63] >> (place % 63)) & 1).astype(bool) & (sizes > 0)
            ends, chosen = np.cumsum(sizes), np.flatnonzero(new)
            packed = [hashes[ends[i] - sizes[i] : ends[i]].tobytes() for i in chosen]
            yield pa.RecordBatch.from_arrays([pa.array(own[chosen], pa.int64()), pa.array(packed, pa.binary())], names=["mark", "shingles"])

    found = docs.mapInArrow(pick, "mark bigint, shingles binary").join(marks, "mark", "left_semi")
    return stored(found.dropDuplicates(["mark"]), "odd-sets")


def _apart(words: list[str]) -> Column:
    return sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"hub_{w}"))) for w in words), F.lit(0))


def near_copies(
    docs: DataFrame,
    size: int = SIZE,
    least: int = LEAST,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    A document's set holds the distinct runs of ``size`` words, A-Z as a-z; a
    shorter text is one run, a text without words (or NULL) has none and links
    with nothing.  Sets link if their intersection is at least ``least``
    percent of their union, found on the full sets; the component is the
    smallest id that links and equal sets lead to, and that document is kept.

    Equal sets are one from the start.  560 MinHash samples are taken of each
    set; 280 of them make 56 bands, and all of them an odd sketch; a second one
    is of the whole set, exact but for few collisions where sets are small.
    Sets that agree in a band are candidates.  In a few passes each set is
    compared with one other: of the sets that are first in its bands (by
    another hash each pass) that which it shares most bands with, or from the
    second pass on the closest by sketches, if any is not ruled out.  Bands whose
    sets lie in one component are done.  In the others all sets outside the
    band's largest component, some 16, then 256, ... at a time in an order given
    by hashes, are compared with all sets of the band in other components: of
    the pairs that no sketch rules out the closest of each set first, then all
    that are still in different components.  Two sets of the largest component
    need no comparison, so no candidate is dropped, and a large group of copies
    costs a few comparisons for each set.  A group of sets that are nearly, but
    not quite similar enough costs up to a sketch comparison for each pair of it
    in a band, spread over tasks by Spark's handling of skewed joins.

    Samples are random: two sets that link share no band, or are ruled out by
    their sketches, with a chance below 1e-7 each; larger similarities do so
    still less.  Equal shingles and sets are found by hashes of 63 bits or more.

    Documents without id take part but do not name a component; where no
    document of it has an id, ``component_id`` is NULL and all are kept.
    Repeated rows get a row each.  No rows give no rows.  Other columns are
    not read.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    made = stored(sampled(source, size), "odd-sampled")
    documents = made.where("signs is null").select("doc_id", "mark", F.col("size").alias("n_shingles"))
    sets = stored(made.where("signs is not null").drop("doc_id").dropDuplicates(["mark"]), "odd-different")
    members = sets.select("mark", "size", F.explode("signs").alias("sign"))
    bands = stored(
        members.groupBy("sign")
        .agg(F.min("mark").alias("hub"), F.max("mark").alias("top"))
        .where("hub < top")
        .select("sign", "hub"),
        "odd-bands",
    )
    shared = stored(members.join(bands, "sign").select("sign", "mark", "size", "hub"), "odd-shared")
    labels = _labels(source, sets.select("mark", *WORDS, *FULL), shared, size, least)
    named = stored(
        documents.join(labels.withColumnRenamed("node", "mark"), "mark", "left").select(
            "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "mark")).alias("component")
        ),
        "odd-named",
    )
    first = stored(
        named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least_id")), "odd-first"
    )
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    return (
        named.join(first, "component", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _best_hubs(candidates: DataFrame) -> DataFrame:
    """``low, high``: each ``mark`` and that ``hub`` which it shares most bands with."""
    return (
        candidates.groupBy("mark", "hub")
        .agg(F.count("*").alias("n"))
        .groupBy("mark")
        .agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
        .select(F.least("mark", "hub").alias("low"), F.greatest("mark", "hub").alias("high"))
        .distinct()
    )


def _component(frame: DataFrame, labels: DataFrame, mark: str, name: str) -> DataFrame:
    """``frame`` plus the component of ``mark``; a set without links is its own."""
    named = labels.select(F.col("node").alias(mark), F.col("component").alias(name))
    return frame.join(named, mark, "left").withColumn(name, F.coalesce(name, mark))


def _labels(source: DataFrame, sketches: DataFrame, shared: DataFrame, size: int, least: int) -> DataFrame:
    """``node, component`` of all linked sets, see :func:`near_copies`."""
    used = stored(shared.select("mark").distinct(), "odd-used")
    sets = full_sets(source, used, size)
    sketches = stored(held(sketches, used, used.count()), "odd-sketches")
    like = F.least("size", "hub_size") * 100 >= F.greatest("size", "hub_size") * least
    near = (_apart(WORDS) <= most_apart(least)) & (
        _apart(FULL) * (100 + least) <= (F.col("size") + F.col("hub_size")) * (100 - least)
    )
    turn = F.shiftrightunsigned(F.xxhash64("mark", "sign"), 11) / F.lit(float(1 << 53))

    def extended(labels: DataFrame | None, pairs: DataFrame) -> DataFrame:
        """``labels`` with the links among ``pairs``."""
        links = stored(linked(pairs, sets, least).select("high", "low"), "odd-links")
        if labels is None:
            return components(links)
        if links.isEmpty():
            return labels
        stars = labels.where("node <> component").select(F.col("node").alias("high"), F.col("component").alias("low"))
        return components(stars.union(links))

    tried = stored(_best_hubs(shared.where("mark > hub")), "odd-pairs")
    labels, passes, hubs_at_once = extended(None, tried), 1, HUBS
    left = shared.select("sign", "mark", "size")
    while True:
        placed = stored(_component(left, labels, "mark", "component"), "odd-placed")
        # Of bands with the same sets one is enough.
        opened = stored(
            placed.groupBy("sign", "component")
            .agg(
                F.count("*").alias("members"),
                F.bit_xor(F.xxhash64("mark")).alias("some"),
                F.bit_xor(F.xxhash64("mark", F.lit(1))).alias("more"),
                F.min(F.struct(F.xxhash64("mark", F.lit(passes)).alias("h"), "mark", "size", "component")).alias("hub"),
            )
            .groupBy("sign")
            .agg(
                F.sum("members").alias("members"),
                (F.sum("members") - F.max("members")).alias("minor"),
                F.max_by("component", F.struct("members", "component")).alias("major"),
                F.bit_xor("some").alias("some"),
                F.bit_xor("more").alias("more"),
                F.min("hub").alias("hub"),
            )
            .where("minor > 0")
            .groupBy("members", "some", "more")
            .agg(F.min_by(F.struct("sign", "major", "minor", "hub"), "sign").alias("band"))
            .select("band.*")
            .select("sign", "major", "minor", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("mark", "size", "component")]),
            "odd-open",
        )
        if opened.isEmpty():
            return labels
        if passes < PASSES:
            met = placed.join(opened, "sign").where((F.col("component") != F.col("hub_component")) & like)
            met = met.groupBy("mark", "size", "hub_mark", "hub_size").agg(F.count("*").alias("n"))
            of_hubs = sketches.select(*[F.col(c).alias(f"hub_{c}") for c in sketches.columns if c != "size"])
            closest = met.join(sketches, "mark").join(of_hubs, "hub_mark").where(near).groupBy("mark")
            best = F.struct(-_apart(FULL) / (F.col("size") + F.col("hub_size")), "n", "hub_mark")
            pairs = closest.agg(F.max_by("hub_mark", best).alias("hub")).select(
                F.least("mark", "hub").alias("low"), F.greatest("mark", "hub").alias("high")
            )
            pairs = stored(pairs.distinct().join(tried, ["low", "high"], "left_anti"), "odd-pairs")
            tried = stored(tried.union(pairs), "odd-tried")
            labels, passes = extended(labels, pairs), passes + 1
            continue
        open_bands = opened.select("sign", "major", "minor")
        is_hub = (F.col("component") != F.col("major")) & (turn * F.col("minor") < hubs_at_once)
        still = placed.join(open_bands, "sign").withColumn("is_hub", is_hub)
        if WORDS[0] not in left.columns:  # joined once, and kept for later rounds
            still = still.join(sketches, "mark")
        still = stored(still.drop("major", "minor"), "odd-still")
        hubs = still.where("is_hub").select(
            "sign", *[F.col(c).alias(f"hub_{c}") for c in ("mark", "size", "component", *WORDS, *FULL)]
        )
        once = ~F.col("is_hub") | (F.col("mark") > F.col("hub_mark"))
        pairs = stored(
            still.join(hubs, "sign")
            .where(once & (F.col("component") != F.col("hub_component")) & like & near)
            .select(
                F.col("hub_mark").alias("mark"),
                F.least("mark", "hub_mark").alias("low"),
                F.greatest("mark", "hub_mark").alias("high"),
                (_apart(FULL) / (F.col("size") + F.col("hub_size"))).alias("apart"),
            )
            .distinct()
            .join(tried, ["low", "high"], "left_anti"),
            "odd-pairs",
        )
        closest = stored(
            pairs.groupBy("mark").agg(F.min_by(F.struct("low", "high"), "apart").alias("pair")).select("pair.*").distinct(),
            "odd-closest",
        )
        labels = extended(labels, closest)
        rest = pairs.select("low", "high").distinct().join(closest, ["low", "high"], "left_anti")
        rest = _component(_component(rest, labels, "low", "one"), labels, "high", "other").where("one <> other")
        rest = stored(rest.select("low", "high"), "odd-rest")
        labels = extended(labels, rest)
        tried = stored(tried.union(closest).union(rest), "odd-tried")
        left = still.where("not is_hub").drop("component", "is_hub")
        hubs_at_once *= MORE


def op12_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their near copies."""
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
