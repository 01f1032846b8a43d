"""Jaccard similarity join of word shingles by PartEnum signatures.

Sets of similar size share an *instance*.  In each instance the domain of
shingle hashes is cut into equal ranges; ``groups`` groups of ``cut`` ranges
each, and every choice of ``take`` ranges of a group is a signature of the
shingles in them.  Two sets that link differ in at most ``differ`` shingles,
so they agree in some signature; ``shape_of`` chooses the numbers such that
they agree in at least ``shared`` signatures that are not empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, exp
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.components import EACH, components
from tallywood.llm.rows import BITS, is_set
from tallywood.llm.tables import narrowed, stored
from tallywood.llm.words import U, Slice, give_back, lean, mix, slices, windows, words_of

SIZE, LEAST = 5, 75  # words of a shingle; similarity in percent
FAMILIES, BLOCK_SHINGLES, SPARE = 6, 300_000, 0.08
#: Bytes of text whose signatures meet in one task at most, in the mean, and signatures that a task deals out at once.
PIECE_BYTES, DEALT = 8 << 20, 1_000_000
#: Bytes of text that a task works on at once, and signatures in one Arrow batch. Both only bound memory.
TEXT_BYTES, BATCH = 1 << 18, 200_000
MARK_BITS = 25
SKETCH_BITS = 10
SKETCH = (1 << SKETCH_BITS) // 64
# Sets of each group compared with the rest of it in the first round; each later round takes so many times more.
HUBS = 16
# Pairs of sets that a task compares at least, where there are so many.
COMPARED = 500
WORDS = [f"w{i}" for i in range(SKETCH)]
# Shingles in so many of so many sampled texts are common.
SAMPLE, COMMON = 10_000, 5
SEEDS = mix(np.arange(1, 64, dtype=U))


class Shape(NamedTuple):
    """How an instance cuts the domain; ``spare`` groups may be empty in part."""

    groups: int
    cut: int
    take: int
    spare: int
    shared: int


def differ(low: int, least: int) -> int:
    """Most shingles in which a set of up to ``low`` and a linked set no smaller differ."""
    high = low * 100 // least
    return (low + high) * (100 - least) // (100 + least)


@lru_cache(maxsize=None)
def bands(least: int, up_to: int) -> tuple[tuple[int, int], ...]:
    """First and last size of each band; a linked set is in the same or the next."""
    made, low = [], 1
    while low <= up_to:
        high = max(low, low * 100 // least)
        made.append((low, high))
        low = high + 1
    return tuple(made)


@lru_cache(maxsize=None)
def shape_of(low: int, high: int, least: int, again: bool = False) -> Shape | None:
    """None if different sets of this instance never link.

    Few differences: one group, all choices that leave out so many ranges.
    Many: a range for each signature, and as many ranges as can differ, can be
    empty (of a set of the least size; ``spare``) and shall agree at least.
    Sets that try ``again`` are full of common shingles: they get ranges of
    half a shingle each, of which linked sets share very many, so that almost
    half of the signatures, the commonest ones, can be left out.
    """
    most = differ(high, least)
    if most == 0:
        return None
    if most <= 3:
        return Shape(1, most + 4, 4, 0, 1)
    if again:
        spare = ceil(2 * low * exp(-0.5))
        return Shape(2 * low, 1, 1, spare, 2 * low - most - spare)
    groups = most + 2
    while True:
        empty = groups * exp(-low / groups)
        spare, shared = ceil(empty), 1 + ceil(SPARE * groups)
        if groups >= most + spare + shared:
            return Shape(groups, 1, 1, spare, groups - most - spare)
        groups += max(1, (most + spare + shared - groups) // 2)


def shingle_sets(part: Slice, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of all distinct shingles of a slice, in order of both.

    A text with fewer than ``size`` words is one shingle, without words none.
    """
    words = words_of(part, lower=True)
    at, hashes = windows(words, size)
    rows = words.rows[at]
    for length in range(1, size):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            at, found = windows(words, length)
            mine = np.isin(words.rows[at], short)
            rows, hashes = np.concatenate([rows, words.rows[at][mine]]), np.concatenate([hashes, found[mine]])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def set_marks(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 63-bit mark of each row's set; equal sets have equal marks."""
    sizes = np.bincount(rows, minlength=n)
    sums = np.concatenate([np.zeros(1, dtype=U), np.cumsum(mix(hashes ^ SEEDS[60]))])
    ends = np.cumsum(sizes)
    marks = mix((sums[ends] - sums[ends - sizes]) + sizes.astype(U) * SEEDS[61])
    return sizes, (marks >> U(1)).astype(np.int64)


def signatures(rows: np.ndarray, hashes: np.ndarray, n: int, shape: Shape, seed: int, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and value of every signature, and which rows have too many empty groups.

    ``rows, hashes`` are sorted sets of rows 0 to n - 1.  Empty signatures are
    left out, but for rows with too many of them if this is the ``last`` try.
    """
    parts = shape.groups * shape.cut
    place = ((hashes >> U(32)) * U(parts) >> U(32)).astype(np.int64)
    key = rows * parts + place
    firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=int)
    sums = np.add.reduceat(mix(hashes + SEEDS[seed % 50]), firsts) if len(firsts) else np.zeros(0, dtype=U)
    key = key[firsts]
    if shape.cut == 1:
        empties = shape.groups - np.bincount(key // parts, minlength=n)
        sparse = empties > shape.spare
        if last and sparse.any():
            # Every range of those rows, the empty ones with sum 0.
            full = np.zeros((int(sparse.sum()), parts), dtype=U)
            where = np.cumsum(sparse) - 1
            mine = sparse[key // parts]
            full[where[key[mine] // parts], key[mine] % parts] = sums[mine]
            key = np.concatenate([key[~mine], (np.flatnonzero(sparse)[:, None] * parts + np.arange(parts)).ravel()])
            sums = np.concatenate([sums[~mine], full.ravel()])
        out_rows, choice = key // parts, (key % parts).astype(U)
    else:
        table, filled = np.zeros((n, parts), dtype=U), np.zeros((n, parts), dtype=bool)
        table[key // parts, key % parts], filled[key // parts, key % parts] = sums, True
        empty_groups = np.zeros(n, dtype=np.int64)
        found = []
        for group in range(shape.groups):
            some_empty = np.zeros(n, dtype=bool)
            for number, chosen in enumerate(combinations(range(shape.cut), shape.take)):
                at = [group * shape.cut + c for c in chosen]
                nothing = ~filled[:, at].any(axis=1)
                some_empty |= nothing
                found.append((nothing, mix(table[:, at] + SEEDS[: len(at)]).sum(axis=1), group * comb(shape.cut, shape.take) + number))
            empty_groups += some_empty
        sparse = empty_groups > shape.spare
        keep = [~nothing | (sparse & last) for nothing, _, _ in found]
        out_rows = np.concatenate([np.flatnonzero(k) for k in keep])
        sums = np.concatenate([s[k] for k, (_, s, _) in zip(keep, found)])
        choice = np.concatenate([np.full(int(k.sum()), c, dtype=U) for k, (_, _, c) in zip(keep, found)])
    return out_rows, mix(sums + mix(choice * SEEDS[55] + U(seed))), sparse


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def set_signatures(
    rows: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, least: int, common: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``slot``, rows and signatures of sorted sets; a slot is a try of an instance.

    A set takes part in the instance of its own band and in those of smaller
    sets it may link with.  The first try leaves out ``common`` shingles, which
    never makes two sets differ more.  Sets with too many empty groups try
    again with all their shingles and another cut of the domain, in which they
    then are with all others that do.
    """
    rare = ~is_in(hashes, common)
    cuts = bands(least, max(1, int(sizes.max(initial=1))))
    lows = np.array([b[0] for b in cuts])
    own = np.searchsorted(lows, sizes, "right") - 1
    lowest = np.searchsorted(lows, -(-sizes * least // 100), "right") - 1
    for instance, (low, high) in enumerate(cuts):
        shape = shape_of(low, high, least)
        retry = shape_of(low, high, least, again=True)
        chosen = np.flatnonzero((lowest <= instance) & (instance <= own) & (sizes > 0))
        if shape is None or not len(chosen):
            continue
        mine = np.isin(rows, chosen)
        at, values, used = np.searchsorted(chosen, rows[mine]), hashes[mine], rare[mine]
        for family in range(FAMILIES):
            seed = instance * FAMILIES + family
            if family:
                values = mix(values ^ SEEDS[family])
                order = np.lexsort((values, at))
                at, values, used = at[order], values[order], np.ones(len(at), dtype=bool)
            found, signs, sparse = signatures(at[used], values[used], len(chosen), retry if family else shape, seed, family == FAMILIES - 1)
            yield seed, chosen[found], signs
            if not sparse.any():
                break
            again = sparse[at]
            at, values, chosen = (np.cumsum(sparse) - 1)[at[again]], values[again], chosen[sparse]


def allowance(least: int) -> list[int]:
    """For each slot, how many of its commonest signatures a set may leave out."""
    shapes = [
        shape_of(*b, least, again=family > 0) for b in bands(least, 1 << 40) for family in range(FAMILIES)
    ]
    return [s.shared - 1 if s else 0 for s in shapes]


SENT = "part int, slot binary, sign binary, mark binary, size binary, doc_id binary"
MET = "kind int, slot int, sign bigint, mark bigint, size bigint, n bigint, doc_id bigint"
NO_ID = np.iinfo(np.int64).min


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in SENT.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of rows: ids, shingle rows and hashes, set sizes and marks."""
    for batch in batches:
        held, ids, total, n = [], [], 0, 0
        for part in slices(batch.column(1), TEXT_BYTES):
            rows, hashes = shingle_sets(part, size)
            held.append((rows + n, hashes, *set_marks(rows, hashes, len(part))))
            ids.append(batch.column(0).slice(part.first, len(part)))
            total, n = total + len(rows), n + len(part)
            if total > BLOCK_SHINGLES:
                yield pa.concat_arrays(ids), *(np.concatenate(h) for h in zip(*held))
                held, ids, total, n = [], [], 0, 0
        if held:
            yield pa.concat_arrays(ids), *(np.concatenate(h) for h in zip(*held))


def _as_numbers(ids: pa.Array) -> np.ndarray:
    return np.where(ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), NO_ID)


def common_shingles(docs: DataFrame, size: int, n_docs: int) -> np.ndarray:
    """Sorted hashes of shingles found often in a bounded sample of texts.

    They only steer which signatures are made: links do not depend on them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, hashes, _, _ in _blocks(batches, size):
            found, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    share = min(1.0, SAMPLE / max(1, n_docs))
    found = (
        docs.sample(share, seed=1)
        .mapInArrow(lean(count), "shingle bigint, n bigint")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= COMMON)
        .select("shingle")
        .toArrow()  # of the sample's shingles, a fifth at most; 8 bytes each, where a Row takes some 500
    )
    return np.sort(found["shingle"].to_numpy().view(U))


def dealt(docs: DataFrame, parts: int, size: int, least: int, common: np.ndarray) -> DataFrame:
    """Signatures by the part they go to, and a row with ``doc_id, mark, size`` of the documents of each block.

    A row holds all that a million signatures of a task have for one part,
    whatever their slots, so there are as many rows as such rounds times parts.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: tuple[list[np.ndarray], ...] = [], [], [], []
        pending = 0

        def out() -> Iterator[pa.RecordBatch]:
            """All that is held, by part and slot; a few parts at a time are copied for it."""
            columns = []
            for pieces in held:
                columns.append(np.concatenate(pieces))
                pieces.clear()
            part = ((columns[1] >> U(32)) % U(parts)).astype(np.uint16 if parts < 65_536 else np.int64)
            order = np.lexsort((columns[0], part))
            ends = np.cumsum(np.bincount(part, minlength=parts))
            del part
            rows, n, first = [], 0, 0
            for number, end in enumerate(ends):
                if end > first:
                    rows.append((number, *[c[order[first:end]].tobytes() for c in columns], b""))
                    n, first = n + end - first, end
                if n > BATCH:
                    yield _sent(rows)
                    rows, n = [], 0
            if rows:
                yield _sent(rows)

        for number, (ids, rows, hashes, sizes, marks) in enumerate(_blocks(batches, size)):
            texts = (marks.tobytes(), sizes.astype(np.int32).tobytes(), _as_numbers(ids).tobytes())
            yield _sent([((task + number) % parts, b"", b"", *texts)])
            first = np.zeros(len(marks), dtype=bool)
            first[np.unique(marks, return_index=True)[1]] = True
            keep = first[rows]
            for slot, at, signs in set_signatures(rows[keep], hashes[keep], np.where(first, sizes, 0), least, common):
                for pieces, found in zip(held, (np.full(len(signs), slot, dtype=np.uint16), signs, marks[at], sizes[at].astype(np.int32))):
                    pieces.append(found)
                pending += len(signs)
            if pending > DEALT:
                yield from out()
                pending = 0
                give_back()
        if pending:
            yield from out()

    return docs.mapInArrow(lean(send), SENT)


def meet(docs: DataFrame, parts: int, size: int, least: int) -> DataFrame:
    """Rows of kind 0, ``doc_id, mark, size`` of each document, and of kind 1: signatures of several sets.

    Equal sets count once in a task, and once where signatures meet.  Signatures
    are dealt to ``parts`` tasks, or more where the text is larger, so that what
    a task holds does not grow with the text.
    """
    n_docs, n_bytes = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    common = common_shingles(docs, size, n_docs)
    parts = max(parts, -(-n_bytes // PIECE_BYTES))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MET.split(", ")]
        held: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            for slot, sign, mark, count, ids in zip(*[batch.column(c) for c in ("slot", "sign", "mark", "size", "doc_id")]):
                slot, sign = np.frombuffer(slot.as_buffer(), dtype=np.uint16), np.frombuffer(sign.as_buffer(), dtype=U)
                mark = np.frombuffer(mark.as_buffer(), dtype=np.int64)
                count = np.frombuffer(count.as_buffer(), dtype=np.int32).astype(np.int64)
                if len(slot):
                    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1), len(slot)]
                    for a, b in zip(cuts, cuts[1:]):
                        held.setdefault(int(slot[a]), []).append([sign[a:b], mark[a:b], count[a:b]])
                    continue
                number = np.frombuffer(ids.as_buffer(), dtype=np.int64)
                none = pa.nulls(len(mark), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(mark), dtype=np.int32)), pa.nulls(len(mark), pa.int32()), none, pa.array(mark),
                     pa.array(count), none, pa.array(number, mask=number == NO_ID)], names=names,
                )
        yield from several_of(held, names)

    def several_of(held: dict[int, list[list[np.ndarray]]], names: list[str]) -> Iterator[pa.RecordBatch]:
        """The signatures that several sets hold; leaves ``held`` empty."""
        for slot in list(held):
            sign, mark, count = (np.concatenate(c) for c in zip(*held.pop(slot)))
            order = np.argsort(sign, kind="stable")
            sign, mark, count = sign[order], mark[order], count[order]
            several = np.zeros(len(sign) + 1, dtype=bool)
            several[1:-1] = sign[1:] == sign[:-1]
            several = several[:-1] | several[1:]
            sign, mark, count = sign[several], mark[several], count[several]
            order = np.lexsort((mark, sign))
            sign, mark, count = sign[order], mark[order], count[order]
            new = np.ones(len(sign), dtype=bool)
            new[1:] = (sign[1:] != sign[:-1]) | (mark[1:] != mark[:-1])
            sign, mark, count = sign[new], mark[new], count[new]
            if not len(sign):
                continue
            firsts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
            lengths = np.diff(np.append(firsts, len(sign)))
            n = np.repeat(lengths, lengths)
            keep = n > 1
            m = int(keep.sum())
            for a in range(0, m, 200_000):
                cut = slice(a, a + 200_000)
                k = min(200_000, m - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(k, dtype=np.int32)), pa.array(np.full(k, slot, dtype=np.int32)), pa.array(sign[keep][cut].view(np.int64)),
                     pa.array(mark[keep][cut]), pa.array(count[keep][cut]), pa.array(n[keep][cut]), pa.nulls(k, pa.int64())], names=names,
                )

    return stored(
        dealt(docs, parts, size, least, common).repartitionById(parts, F.col("part")).mapInArrow(lean(group), MET),
        "jaccard-met",
    )


def mark_bits(marks: DataFrame) -> DataFrame:
    """``chunk, bits`` of a table of ``2**MARK_BITS`` bits with those of ``marks`` set: 1,024 bitmaps of 4 KB at most."""
    place = F.col("mark") % (1 << MARK_BITS)
    placed = marks.select(F.floor(place / BITS).alias("chunk"), (place % BITS).alias("bit"))
    return placed.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))


def marked_bits(marks: DataFrame) -> np.ndarray:
    """:func:`mark_bits` as an array of bytes; false hits only cost."""
    table = np.zeros((1 << MARK_BITS) // 8, dtype=np.uint8)
    for chunk, bits in mark_bits(marks).collect():  # bounded by the table, 4 MB
        table[chunk * BITS // 8 :][: len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return table


def held(frame: DataFrame, marks: DataFrame, n_marks: int) -> DataFrame:
    """Rows of ``frame`` whose ``mark`` is one of ``n_marks`` in ``marks``, and few others.

    Every task gets the bounded table of bits, so what a join would not match
    is not shuffled for it.
    """
    table = narrowed(mark_bits(narrowed(marks, n_marks, EACH)), n_marks, EACH)
    place = F.col("mark") % (1 << MARK_BITS)
    found = frame.withColumn("place", place).join(F.broadcast(table), F.floor(F.col("place") / BITS) == F.col("chunk"))
    return found.where(is_set("bits", "place")).select(*frame.columns)


def sketches(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """``SKETCH`` words for each of ``n`` sets: the parity of its shingles at each bit.

    A shingle that only one of two sets has turns one bit, so two sketches
    never differ in more bits than the sets do in shingles.
    """
    words = np.zeros(n * SKETCH, dtype=U)
    place = mix(hashes ^ SEEDS[59]) >> U(64 - SKETCH_BITS)
    np.bitwise_xor.at(words, rows * SKETCH + (place >> U(6)).astype(np.int64), U(1) << (place & U(63)))
    return words.reshape(n, SKETCH).view(np.int64)


def sets_of(docs: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """``mark, shingles`` of the sets in ``marks``, as sorted packed hashes, and the words of their sketches."""
    bits = marked_bits(marks)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, rows, hashes, sizes, own in _blocks(batches, size):
            place = own % (1 << MARK_BITS)
            wanted = ((bits[place >> 3] >> (place & 7)) & 1).astype(bool) & (sizes > 0)
            ends = np.cumsum(sizes)
            chosen = []
            for i in np.flatnonzero(wanted):
                if own[i] not in seen:
                    seen.add(own[i])
                    chosen.append(i)
            if chosen:
                at = np.full(len(sizes), -1)
                at[chosen] = np.arange(len(chosen))
                mine = at[rows] >= 0
                words = sketches(at[rows[mine]], hashes[mine], len(chosen))
                packed = [hashes[ends[i] - sizes[i] : ends[i]].tobytes() for i in chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[chosen], pa.int64()), pa.array(packed, pa.binary()), *[pa.array(w) for w in words.T]],
                    names=["mark", "shingles", *WORDS],
                )

    # A set comes at most once from each task; any of its copies will do.
    schema = ", ".join(["mark bigint, shingles binary", *[f"{w} bigint" for w in WORDS]])
    found = docs.mapInArrow(lean(pick), schema).join(marks, "mark", "left_semi")
    return stored(found.dropDuplicates(["mark"]), "jaccard-sets")


def linked(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Those of ``pairs`` (``low, high``) whose sets are as similar as asked."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for i, (one, other) in enumerate(zip(batch.column(2), batch.column(3))):
                a, b = (np.frombuffer(x.as_buffer(), dtype=U) for x in (one, other))
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                both = int((b[at] == a).sum()) if len(b) else 0
                keep[i] = 100 * both >= least * (len(a) + len(b) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    n_pairs = pairs.count()

    def of(end: str) -> DataFrame:
        mine = held(sets.select("mark", "shingles"), pairs.select(F.col(end).alias("mark")), n_pairs)
        return mine.select(F.col("mark").alias(end), F.col("shingles").alias(f"of_{end}"))

    met = pairs.join(of("high"), "high").join(of("low"), "low").select("low", "high", "of_low", "of_high")
    return narrowed(met, n_pairs, COMPARED).mapInArrow(lean(compare), "low bigint, high bigint")


def jaccard_components(
    docs: DataFrame,
    size: int = SIZE,
    least: int = LEAST,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    A document's set holds the distinct runs of ``size`` words, A-Z as a-z; a
    shorter text is one run, a text without words (or NULL) has none and links
    with nothing.  Sets link if their intersection is at least ``least``
    percent of their union; the component is the smallest id that links and
    equal sets lead to.

    Equal sets are one from the start.  Signatures that several sets share are
    kept; a set leaves out as many of its commonest ones as linked sets share
    more than one.  Then each set is compared with one other, of the sets that
    come first in its groups (the sets with one signature) that which it shares
    most groups with, and the links so far become components.  Groups whose
    sets lie in one component are done.  In the others each set is compared once
    more with one, the closest by sketch; then all sets outside the group's
    largest component, some 16, then 256, ... at a time in an order given by
    hashes, are compared with those of other components; a sketch
    of 1,024 parities, in which sets never differ more than in their shingles,
    rules out most pairs before sets are sent.  So every link is found or lies
    within a component already, while a large group of near copies costs about
    one comparison for each set.  Sketches tell little about sets of over some
    1,800 shingles, whose pairs are then all compared.  Shingles, sets and
    groups are told apart by hashes of 64 bits or more.

    ``parts`` (default: the session's shuffle partitions) divides the
    signatures at least; a task holds those of some 8 MB of text.  Documents without id take part but do
    not name a component, which is NULL if none of its documents has an id.
    Repeated rows get a row each.  No rows give no rows.  Other columns are not
    read.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    met = meet(source, parts, size, least)
    documents = met.where("kind = 0").select("doc_id", "mark", F.col("size").alias("n_shingles"))
    commonest = Window.partitionBy("mark", "slot").orderBy(F.desc("n"), "sign")
    allowed = F.element_at(F.array(*[F.lit(a) for a in allowance(least)]), F.col("slot") + 1)
    members = stored(
        met.where("kind = 1")
        .withColumn("place", F.row_number().over(commonest))
        .where(F.col("place") > allowed)
        .select(F.xxhash64("slot", "sign").alias("sign"), "mark", "size"),
        "jaccard-members",
    )
    labels = _linked_components(source, members, size, least)
    named = documents.join(labels.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
        "component", F.coalesce("component", "mark")
    )
    # A text without words is alone; others go by component.
    named = stored(named.select("doc_id", "n_shingles", "component"), "jaccard-named")
    first = stored(
        named.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-first"
    )
    return (
        named.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")))
        .join(first, "component", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def _linked_components(source: DataFrame, members: DataFrame, size: int, least: int) -> DataFrame:
    """``node, component`` of all linked sets, see :func:`jaccard_components`."""
    like = F.least("size", "hub_size") * 100 >= F.greatest("size", "hub_size") * least
    # By the set alone, so that its groups have the same sets to compare the others with.
    turn = F.shiftrightunsigned(F.xxhash64("mark"), 11) / F.lit(float(1 << 53))
    apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"hub_{w}"))) for w in WORDS), F.lit(0))
    near = apart * (100 + least) <= (F.col("size") + F.col("hub_size")) * (100 - least)
    hubs = stored(
        members.groupBy("sign")
        .agg(F.min(F.struct("mark", "size")).alias("hub"), F.max("mark").alias("top"))
        .where("hub.mark < top")
        .select("sign", F.col("hub.mark").alias("hub"), F.col("hub.size").alias("hub_size")),
        "jaccard-hubs",
    )
    left = stored(members.join(hubs.select("sign"), "sign"), "jaccard-left")
    # First each set with that one which it shares most signatures with.
    pairs = stored(
        left.join(hubs, "sign")
        .where((F.col("mark") > F.col("hub")) & like)
        .groupBy("mark", "hub")
        .agg(F.count("*").alias("n"))
        .groupBy(F.col("mark").alias("high"))
        .agg(F.max_by("hub", F.struct("n", "hub")).alias("low"))
        .select("low", "high"),
        "jaccard-pairs",
    )
    sets = sets_of(source, stored(left.select("mark").distinct(), "jaccard-used"), size)
    links = stored(linked(pairs, sets, least).select("high", "low"), "jaccard-links")
    tried = pairs
    hubs_at_once, closest_next = HUBS, True
    labels = components(links)

    def extended(pairs: DataFrame) -> DataFrame:
        """``labels`` with the links among ``pairs``."""
        links = stored(linked(pairs, sets, least).select("high", "low"), "jaccard-links")
        if links.isEmpty():
            return labels
        stars = labels.where("node <> component").select(F.col("node").alias("high"), F.col("component").alias("low"))
        return components(stars.union(links))

    while True:
        placed = stored(
            left.join(labels.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
                "component", F.coalesce("component", "mark")
            ),
            "jaccard-placed",
        )
        # Of groups with the same sets one is enough.
        open_groups = stored(
            placed.groupBy("sign", "component")
            .agg(
                F.count("*").alias("members"),
                F.bit_xor(F.xxhash64("mark")).alias("some"),
                F.bit_xor(F.xxhash64("mark", F.lit(1))).alias("more"),
                F.min(F.struct(F.xxhash64("mark", "sign").alias("h"), "mark", "size", "component")).alias("hub"),
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
            .agg(F.min_by(F.struct("sign", "major", "minor", "hub"), "sign").alias("group"))
            .select("group.*")
            .select("sign", "major", "minor", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("mark", "size", "component")]),
            "jaccard-open",
        )
        if open_groups.isEmpty():
            return labels
        if closest_next:
            # Each set with the closest of one of each of its groups, so that few are left to compare with many.
            met = placed.join(open_groups, "sign").where((F.col("component") != F.col("hub_component")) & like)
            of_hubs = sets.select(F.col("mark").alias("hub_mark"), *[F.col(w).alias(f"hub_{w}") for w in WORDS])
            met = met.select("mark", "size", "hub_mark", "hub_size").distinct().join(sets.select("mark", *WORDS), "mark")
            best = F.struct(-apart / (F.col("size") + F.col("hub_size")), "hub_mark")
            pairs = met.join(of_hubs, "hub_mark").where(near).groupBy("mark").agg(F.max_by("hub_mark", best).alias("hub"))
            pairs = pairs.select(F.least("mark", "hub").alias("low"), F.greatest("mark", "hub").alias("high")).distinct()
            pairs = stored(pairs.join(tried, ["low", "high"], "left_anti"), "jaccard-pairs")
            tried, labels, closest_next = tried.union(pairs), extended(pairs), False
            continue
        is_hub = (F.col("component") != F.col("major")) & (turn * F.col("minor") < hubs_at_once)
        still = placed.join(open_groups.select("sign", "major", "minor"), "sign").withColumn("is_hub", is_hub)
        if WORDS[0] not in left.columns:  # joined once, and kept for later rounds
            still = still.join(sets.select("mark", *WORDS), "mark")
        still = stored(still.drop("major", "minor"), "jaccard-still")
        hubs = still.where("is_hub").select(
            "sign",
            *[F.col(c).alias(f"hub_{c}") for c in ("mark", "size", "component", *WORDS)],
        )
        once = ~F.col("is_hub") | (F.col("mark") > F.col("hub_mark"))
        pairs = stored(
            still.join(hubs, "sign")
            .where(once & (F.col("component") != F.col("hub_component")) & like & near)
            .select(F.least("hub_mark", "mark").alias("low"), F.greatest("hub_mark", "mark").alias("high"))
            .distinct()
            .join(tried, ["low", "high"], "left_anti"),
            "jaccard-pairs",
        )
        tried, labels = tried.union(pairs), extended(pairs)
        left = still.where("not is_hub").drop("component", "is_hub")
        hubs_at_once *= HUBS


def op7_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component their shingles put them in."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
