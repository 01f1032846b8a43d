"""Language-model scores by deleted interpolation.

P(w | h) = a2 * c(h, w) / c(h) + a1 * c(w) / N + a0 / (V + 1), where the
weights a depend on how frequent the context h is.

Words at least 1 in ``RARE`` of all training tokens are *frequent*; there are at
most ``RARE`` of them, so their counts can be sent to every task; that is a
short cut and changes no result.  Every word (and the start of a text) is a
context with pair counts of its own.  All tokens of a word that is not frequent
meet in one place, where its own count and its pairs are counted; frequent
words after it are counted there too.  None of those places can be hot.  Where
word and context both are not frequent, the context's count comes from the
context's place in a second step.  Pairs of frequent words are dealt out pair
by pair, but for the most frequent ones, again at most ``RARE``, which are sent
to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.tables import stored
from tallywood.llm.words import U, mix, slices, words_of

RARE = 60_000
END = U(0x454E44)
BLOCK_TOKENS, GROUP_ENTRIES = 1_000_000, 400_000
# Words and contexts below NUMBERS are numbers of frequent words, others are hashes, none of which is so small in practice.
NUMBERS = U(65_536)
# The context that is no word, behind the frequent words' numbers.
START_CONTEXT, NO_WORD = 65_534, 65_535
# Buckets are halvings of a context's share of all tokens; the last is for contexts never seen.
BUCKETS, RARE_BUCKET = 42, 41
# Cells of the held-out histogram: an eighth of a power of two wide, 0 for none.
FINE, CELLS = 8, 400
ROUNDS = 60
NO_ID = np.iinfo(np.int64).min

# Packed values, and from how many bytes on.
CODEC, PLAIN = pa.Codec("zstd", compression_level=1), 200

ROLE_NONE, ROLE_COUNTED, ROLE_HELD = 0, 1, 2


@dataclass
class Model:
    """What every task gets: counts of frequent words and pairs, and the weights."""

    words: np.ndarray  # sorted hashes of the frequent words
    numbers: np.ndarray  # their numbers, from the most frequent word on
    counts: np.ndarray  # (2, words), by number: of the counted part, of all training tokens
    tokens: np.ndarray  # (2,)
    texts: np.ndarray  # (2,): how often the start of a text is a context
    types: int
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    pair_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray | None = None  # (buckets, 3) for a2, a1, a0

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number among the frequent ones, -1 for others."""
        if not len(self.words):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.numbers[at], -1)

    def buckets(self, counts: np.ndarray, part: int) -> np.ndarray:
        """Bucket of contexts with these counts."""
        buckets = np.full(len(counts), RARE_BUCKET)
        used = counts > 0
        share = counts[used] / max(1, self.tokens[part])
        buckets[used] = np.clip(-np.log2(share), 0, RARE_BUCKET - 1).astype(int)
        return buckets

    def contexts(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """Count and bucket of every context that has a number."""
        counts = np.zeros(int(NUMBERS), dtype=np.int64)
        counts[: len(self.words)] = self.counts[part]
        counts[START_CONTEXT] = self.texts[part]
        return counts, self.buckets(counts, part)

    def chance(self, pair: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log10 of P for tokens with these counts of pair, word and context."""
        a = self.weights[self.buckets(context, 1)]
        p2 = pair / np.maximum(context, 1)
        p1 = word / max(1, self.tokens[1])
        return np.log10(a[:, 0] * p2 + a[:, 1] * p1 + a[:, 2] / (self.types + 1))

    def base(self, word: np.ndarray) -> np.ndarray:
        return np.log10((word + 0.5) / (self.tokens[1] + 0.5 * (self.types + 1)))


def token_stream(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of ``(.., text, role)``: first row, rows, and each token's hash, row and predecessor's place.

    A token's predecessor is -1 at the start of a text; the last token of a
    text is its end.
    """
    for part in slices(batch.column(1)):
        words = words_of(part, lower=True)
        counts = words.counts + 1
        ends = np.cumsum(counts)
        hashes = np.full(int(ends[-1]), END, dtype=U)
        is_word = np.ones(len(hashes), dtype=bool)
        is_word[ends - 1] = False
        hashes[is_word] = words.hashes
        before = np.arange(-1, len(hashes) - 1)
        before[ends - counts] = -1
        yield part.first, len(part), hashes, np.repeat(np.arange(len(part)), counts), before


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of ``keys`` and the sums of ``values`` over each."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(hashes) >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """How many bytes of each value are used, the values' lowest bytes, then their second bytes, and so on.

    More than a few are compressed: numbers rise as words get rarer, so most bytes of a plane are alike.
    """
    if not len(values):
        return b""
    found = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    used = max(np.flatnonzero(found.any(axis=1)), default=0) + 1
    plain = found[:used].tobytes()
    if len(plain) < PLAIN:
        return bytes([used]) + plain
    return bytes([used | 128]) + len(values).to_bytes(4, "little") + CODEC.compress(plain, asbytes=True)


def from_planes(cell: pa.Scalar, kind: type) -> np.ndarray:
    found = np.frombuffer(cell.as_buffer(), dtype=np.uint8)
    if not len(found):
        return np.zeros(0, dtype=kind)
    used, data = int(found[0]) & 127, found[1:]
    if found[0] & 128:
        n = int.from_bytes(data[:4].tobytes(), "little")
        data = np.frombuffer(CODEC.decompress(pa.py_buffer(data[4:]), used * n), dtype=np.uint8)
    values = data.reshape(used, -1)
    whole = np.zeros((values.shape[1], np.dtype(kind).itemsize), dtype=np.uint8)
    whole[:, : len(values)] = values.T
    return whole.view(kind).ravel()


#: Columns whose values rise within a cell; what is kept are the steps.
RISING = {"sorted", "row", "at", "place", "asked", "told"}


def dealt(part: np.ndarray, parts: int, arrays: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, bytes]]]:
    """The entries of each part, as bytes."""
    order = np.argsort(part.astype(np.uint16 if parts < 65_536 else np.int64), kind="stable")
    arrays = {n: a[order] for n, a in arrays.items()}
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        own = {n: a[cuts[p] : cuts[p + 1]] for n, a in arrays.items()}
        yield int(p), {n: planes(np.diff(a, prepend=a.dtype.type(0)) if n in RISING else a) for n, a in own.items()}


def gathered(batches: Iterator[pa.RecordBatch], types: dict[str, type]) -> list[np.ndarray]:
    """Like columns of packed entries, all rows together."""
    found: dict[str, list[np.ndarray]] = {n: [np.zeros(0, dtype=t)] for n, t in types.items()}
    for batch in batches:
        for name, kind in types.items():
            for cell in batch.column(name):
                values = from_planes(cell, kind)
                found[name].append(np.cumsum(values, dtype=kind) if name in RISING else values)
    return [np.concatenate(f) for f in found.values()]


def packed(rows: list[tuple[int, dict[str, bytes]]], names: list[str], block: int = 0) -> pa.RecordBatch:
    """Rows of parts and their cells; a column without a cell is empty."""
    fixed = {"part": [p for p, _ in rows], "block": [block] * len(rows)}
    return pa.RecordBatch.from_arrays(
        [
            pa.array(fixed[n], pa.int32() if n == "part" else pa.int64()) if n in fixed else pa.array([cells.get(n, b"") for _, cells in rows], pa.binary())
            for n in names
        ],
        names=names,
    )


def shape_of(names: list[str]) -> str:
    return ", ".join(f"{n} {'int' if n == 'part' else 'bigint' if n == 'block' else 'binary'}" for n in names)


class Sums:
    """Sums by key that a task keeps, and lets go whenever they grow large."""

    def __init__(self, most: int = 2 * BLOCK_TOKENS):
        self.most, self.held, self.pending = most, [], 0

    def add(self, keys: list[np.ndarray], values: list[np.ndarray]) -> bool:
        """True if the sums should be taken."""
        keys, values = summed(keys, values)
        self.held.append((keys, values))
        self.pending += len(values[0])
        if self.pending > self.most:
            keys, values = self.take()
            self.held, self.pending = [(keys, values)], len(values[0])
        return self.pending > self.most // 2

    def take(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        keys = [np.concatenate(k) for k in zip(*[h[0] for h in self.held])]
        values = [np.concatenate(v) for v in zip(*[h[1] for h in self.held])]
        self.held, self.pending = [], 0
        return summed(keys, values)


def _roles(batch: pa.RecordBatch, first: int, rows: np.ndarray) -> np.ndarray:
    return batch.column(2).slice(first).to_numpy(zero_copy_only=False)[rows]


def count_words(docs: DataFrame, parts: int) -> Model:
    """Training tokens, types and frequent words."""
    names = ["part", "sorted", "counted", "held"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()

        def out() -> pa.RecordBatch:
            (word,), (counted, held) = sums.take()
            arrays = {"sorted": word, "counted": counted.astype(np.uint32), "held": held.astype(np.uint32)}
            return packed(list(dealt(part_of(word, parts), parts, arrays)), names)

        for batch in batches:
            for first, _, hashes, rows, _ in token_stream(batch):
                role = _roles(batch, first, rows)
                if sums.add([hashes], [(role == ROLE_COUNTED).astype(np.int64), (role == ROLE_HELD).astype(np.int64)]):
                    yield out()
        if sums.held:
            yield out()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, counted, held = gathered(batches, {"sorted": U, "counted": np.uint32, "held": np.uint32})
        (word,), (counted, held) = summed([word], [counted.astype(np.int64), held.astype(np.int64)])
        yield packed([(0, cells) for _, cells in dealt(np.zeros(len(word), dtype=np.int64), 1, {"sorted": word, "counted": counted, "held": held})], names)

    def frequent(least: float):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    word, counted, held = gathered(iter([batch.slice(i, 1)]), {"sorted": U, "counted": np.int64, "held": np.int64})
                    both = counted + held
                    many = both >= max(1.0, least)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(counted.sum())]), pa.array([int(held.sum())]), pa.array([int((both > 0).sum())]),
                            pa.array([word[many].tobytes()], pa.binary()), pa.array([counted[many].tobytes()], pa.binary()),
                            pa.array([held[many].tobytes()], pa.binary()),
                        ],
                        names=["n_counted", "n_held", "types", "word", "counted", "held"],
                    )

        return pick

    trained = docs.where(F.col("role") > 0)
    totals = stored(
        trained.mapInArrow(count, shape_of(names)).repartitionById(parts, F.col("part")).mapInArrow(total, shape_of(names)), "lm-words"
    )
    shape = "n_counted bigint, n_held bigint, types bigint, word binary, counted binary, held binary"
    n_counted, n_held, types = totals.mapInArrow(frequent(float("inf")), shape).agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_counted", "n_held", "types")]
    ).first()
    rows = totals.mapInArrow(frequent((n_counted + n_held) / RARE), shape).select("word", "counted", "held").collect()  # RARE words at most
    word = np.concatenate([np.zeros(0, dtype=U), *[np.frombuffer(r[0], dtype=U) for r in rows]])
    counted, held = (np.concatenate([np.zeros(0, dtype=np.int64), *[np.frombuffer(r[k], dtype=np.int64) for r in rows]]) for k in (1, 2))
    order = np.lexsort((word, -(counted + held)))
    by_hash = np.argsort(word[order])
    texts = dict(trained.groupBy("role").count().collect())
    return Model(
        word[order][by_hash],
        by_hash,
        np.stack([counted, counted + held])[:, order],
        np.array([n_counted, n_counted + n_held]),
        np.array([texts.get(ROLE_COUNTED, 0), sum(texts.values())]),
        types,
    )


def token_keys(model: Model, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token and its context: a number if frequent, else a hash."""
    number = model.number(hashes)
    word = np.where(number < 0, hashes, number.astype(U))
    return word, np.where(before < 0, U(START_CONTEXT), word[before])


def pair_key(number: np.ndarray, context: np.ndarray) -> np.ndarray:
    return number.astype(np.int64) * int(NUMBERS) + context.astype(np.int64)


def route(word: np.ndarray, context: np.ndarray, parts: int) -> np.ndarray:
    """Words that are not frequent go by word, others by a context that is not frequent, the rest pair by pair."""
    pair = pair_key(word % NUMBERS, context % NUMBERS).astype(U)
    return part_of(np.where(word >= NUMBERS, word, np.where(context >= NUMBERS, context, pair)), parts)


def log_cell(ratio: np.ndarray) -> np.ndarray:
    """Cell of a ratio of probabilities; 0 for none."""
    cell = np.zeros(len(ratio), dtype=np.int64)
    some = ratio > 0
    cell[some] = np.clip(np.round(np.log2(ratio[some]) * FINE) + CELLS // 4, 1, CELLS - 1)
    return cell


def learn_weights(docs: DataFrame, model: Model, parts: int) -> None:
    """Mixture weights by expectation-maximisation on the held-out counts.

    Pairs are counted in the counted and the held part.  Each held-out token
    falls into a cell by its context's bucket and by the two ratios of its
    estimates, from the counted part alone, to the uniform one; the cells are
    bounded in number and are all that the driver sees.  Also finds the most
    frequent pairs.
    """
    names = ["part", "turned", "sorted", "other", "counted", "held"]
    kinds = {"turned": np.uint8, "sorted": U, "other": U, "counted": np.uint32, "held": np.uint32}
    later = {"context": U, "own": np.int64, "counted": np.int64, "held": np.int64, "word": U, "seen": np.int64, "cell": np.int64, "n": np.int64}
    later_names = ["part", *later]
    least = max(1.0, model.tokens[1] / RARE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()

        def out() -> pa.RecordBatch:
            (word, context), (counted, held) = sums.take()
            rows: list[tuple[int, dict[str, bytes]]] = []
            # Numbers and hashes in rows of their own, each sorted by what it is sent by.
            kind = (word >= NUMBERS) * 2 + (context >= NUMBERS)
            for k in range(4):
                at = np.flatnonzero(kind == k)
                if k == 1:
                    at = at[np.argsort(context[at], kind="stable")]
                first, other = (context[at], word[at]) if k == 1 else (word[at], context[at])
                arrays = {
                    "turned": np.full(len(at), k == 1, dtype=np.uint8), "sorted": first, "other": other,
                    "counted": counted[at].astype(np.uint32), "held": held[at].astype(np.uint32),
                }
                rows += dealt(route(word[at], context[at], parts), parts, arrays)
            return packed(rows, names)

        for batch in batches:
            for first, _, hashes, rows, before in token_stream(batch):
                role = _roles(batch, first, rows)
                word, context = token_keys(model, hashes, before)
                if sums.add([word, context], [(role == ROLE_COUNTED).astype(np.int64), (role == ROLE_HELD).astype(np.int64)]):
                    yield out()
        if sums.held:
            yield out()

    def cells_of(seen: np.ndarray, own: np.ndarray, counted: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of pairs with these counts of context, word and pair."""
        ratio2 = counted / np.maximum(seen, 1) * (model.types + 1)
        ratio1 = own / max(1, model.tokens[0]) * (model.types + 1)
        cell = (model.buckets(seen, 0) * CELLS + log_cell(ratio2)) * CELLS + log_cell(ratio1)
        (cell,), (held,) = summed([cell], [held])
        return cell, held

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of pairs whose context's count is known here; the others go to their context's place."""
        from pyspark import TaskContext

        turned, first, other, counted, held = gathered(batches, kinds)
        word, context = np.where(turned == 1, other, first), np.where(turned == 1, first, other)
        del turned, first, other
        (word, context), (counted, held) = summed([word, context], [counted.astype(np.int64), held.astype(np.int64)])
        own = word_counts(model, 0, word, counted)
        seen = context_counts(model, 0, word, own, context)
        many = (word < NUMBERS) & (context < U(len(model.words))) & (counted + held >= least)
        pair = pair_key(word[many], context[many])
        wanted = held > 0
        apart = wanted & (word >= NUMBERS) & (context >= NUMBERS)
        here = wanted & ~apart
        cell, n = cells_of(seen[here], own[here], counted[here], held[here])
        asked = {"context": context[apart], "own": own[apart], "counted": counted[apart], "held": held[apart]}
        rows = list(dealt(part_of(context[apart], parts), parts, asked))
        # Only words of held-out texts are contexts of held-out tokens.
        (rare,), (rare_held,) = summed([word], [held])
        rare = rare[(rare >= NUMBERS) & (rare_held > 0)]
        rare_seen = own[np.searchsorted(word, rare)]
        some = rare_seen > 0
        rows += dealt(part_of(rare[some], parts), parts, {"word": rare[some], "seen": rare_seen[some]})
        ready = {"cell": planes(np.concatenate([cell, -1 - pair])), "n": planes(np.concatenate([n, (counted + held)[many]]))}
        yield packed([*rows, (TaskContext.get().partitionId() % parts, ready)], later_names)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, own, counted, held, word, seen, cell, n = gathered(batches, later)
        order = np.argsort(word)
        more, more_n = cells_of(looked_up(word[order], seen[order], context), own, counted, held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([cell, more])), pa.array(np.concatenate([n, more_n]))], names=["cell", "n"])

    found = (
        docs.where(F.col("role") > 0)
        .mapInArrow(count, shape_of(names))
        .repartitionById(parts, F.col("part"))
        .mapInArrow(pairs, shape_of(later_names))
        .repartitionById(parts, F.col("part"))
        .mapInArrow(cells, "cell bigint, n bigint")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # bounded: the cells, and RARE pairs at most
    )
    cell, n = found["cell"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(-1 - cell[cell < 0])
    model.pairs, model.pair_counts = (-1 - cell[cell < 0])[order], n[cell < 0][order]
    model.weights = mixture_weights(cell[cell >= 0], n[cell >= 0])


def word_counts(model: Model, part: int, word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The word's own count for each of its sorted (word, context) entries."""
    total = np.concatenate([[0], np.cumsum(counts)])
    firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, dtype=int)
    lasts = np.append(firsts[1:], len(word))
    own = np.repeat(total[lasts] - total[firsts], lasts - firsts)
    known = word < NUMBERS
    own[known] = model.counts[part][word[known].astype(np.int64)]
    return own


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Value of each wanted key by sorted ``keys``; 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def context_counts(model: Model, part: int, word: np.ndarray, own: np.ndarray, context: np.ndarray) -> np.ndarray:
    """The context's count for each of the sorted entries of one place, where ``own`` is the word's.

    A context that is not frequent is looked up among the words of this place:
    it is there if the word after it is frequent.
    """
    known = context < NUMBERS
    seen = np.zeros(len(context), dtype=np.int64)
    seen[known] = model.contexts(part)[0][context[known].astype(np.int64)]
    asks = ~known & (word < NUMBERS)
    seen[asks] = looked_up(word, own, context[asks])
    return seen


def mixture_weights(cell: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of each bucket, from cells of held-out tokens; without such tokens those of the nearest bucket."""
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    weights[RARE_BUCKET] = [0.0, 0.9, 0.1]

    def ratio(part: np.ndarray) -> np.ndarray:
        return np.where(part > 0, 2.0 ** ((part - CELLS // 4) / FINE), 0.0)

    bucket = cell // (CELLS * CELLS)
    terms = np.stack([ratio(cell // CELLS % CELLS), ratio(cell % CELLS), np.ones(len(cell))], axis=1)
    for b in np.unique(bucket):
        own, count = terms[bucket == b], n[bucket == b].astype(float)
        for _ in range(rounds):
            share = own * weights[b]
            share *= (count / share.sum(axis=1))[:, None]
            weights[b] = share.sum(axis=0) / share.sum()
        weights[b] = weights[b] + [0.0, 0.0, 1e-6]  # nothing is impossible
        weights[b] /= weights[b].sum()
    learnt = np.unique(bucket)
    learnt = learnt[learnt < RARE_BUCKET]
    for b in range(RARE_BUCKET if len(learnt) else 0):
        weights[b] = weights[learnt[np.argmin(np.abs(learnt - b))]]
    return weights


def score_tokens(docs: DataFrame, model: Model, parts: int) -> DataFrame:
    """Sums per text: ``doc_id, n_tokens, n_known, base_score, score``."""
    names = ["part", "block", "word", "context", "after", "row", "at", "ids", "tokens", "known", "base", "score"]
    wanted = {"word": U, "context": U, "after": np.uint16, "row": np.uint32, "at": np.int64}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        seen = model.contexts(1)[0]
        waiting: list[list[np.ndarray]] = []

        def out() -> pa.RecordBatch:
            word, context, after, row, at = (np.concatenate(a) for a in zip(*waiting))
            waiting.clear()
            # Numbers and hashes in rows of their own.
            to = route(word, context, parts) * 4 + (word >= NUMBERS) * 2 + (context >= NUMBERS)
            arrays = {"word": word, "context": context, "after": after, "row": row, "at": at}
            return packed([(p // 4, cells) for p, cells in dealt(to, parts * 4, arrays)], names, block)

        next_row = next_token = pending = 0
        for batch in batches:
            for first, size, hashes, rows, before in token_stream(batch):
                role = _roles(batch, first, rows)
                word, context = token_keys(model, hashes, before)
                frequent = word < NUMBERS
                count = np.zeros(len(hashes), dtype=np.int64)
                count[frequent] = model.counts[1][word[frequent].astype(np.int64)]
                done = np.zeros(len(hashes), dtype=bool)
                logs = np.zeros(len(hashes))
                if len(model.pairs):
                    both = np.flatnonzero(frequent & (context < NUMBERS))
                    key = pair_key(word[both], context[both])
                    at = np.minimum(np.searchsorted(model.pairs, key), len(model.pairs) - 1)
                    hit = model.pairs[at] == key
                    both, at = both[hit], at[hit]
                    done[both] = True
                    logs[both] = model.chance(model.pair_counts[at], count[both], seen[context[both].astype(np.int64)])
                bases = np.where(frequent, model.base(count), 0.0)
                ids = batch.column(0).slice(first, size)
                texts = {
                    "ids": np.where(ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), NO_ID),
                    "tokens": np.bincount(rows, minlength=size).astype(np.int64),
                    "known": np.bincount(rows, frequent & (count > 0), size).astype(np.int64),
                    "base": np.bincount(rows, bases, size),
                    "score": np.bincount(rows, logs, size),
                }
                yield packed([((next_row // 1000) % parts, {n: planes(a) for n, a in texts.items()})], names, block + next_row)
                if next_row + size >= 1 << 31 or next_token + len(hashes) >= 1 << 32:
                    raise ValueError("more than 2**31 texts or 2**32 tokens in one task")
                # An entry's row keeps in its lowest bit whether it is counted.  A token that is not frequent takes a
                # frequent one after it along, and keeps its place in the task, and in the lowest bit of that whether
                # the next one, not frequent either, needs its count.
                apart = ~frequent & (context >= NUMBERS)
                at = np.where(frequent, 0, (next_token + np.arange(len(hashes))) * 2 + np.append(apart[1:], False))
                row = ((rows + next_row) * 2 + (role > 0)).astype(np.uint32)
                taken = frequent & (context >= NUMBERS)
                after = np.append(np.where(taken[1:], word[1:], U(NO_WORD)), U(NO_WORD)).astype(np.uint16)
                ask = ~done & ~taken
                waiting.append([word[ask], context[ask], after[ask], row[ask], at[ask]])
                pending += int(ask.sum())
                next_row += size
                next_token += len(hashes)
                if pending > BLOCK_TOKENS:
                    yield out()
                    pending = 0
        if waiting:
            yield out()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                block = row.column("block")[0].as_py()
                word, context, after, place, at = gathered(iter([row]), wanted)
                if len(word):
                    found.append([word, context, after, place, at, np.full(len(word), block, dtype=np.int64)])
                    continue
                ids, tokens, known = gathered(iter([row]), {"ids": np.int64, "tokens": np.int64, "known": np.int64})
                base, score = gathered(iter([row]), {"base": np.float64, "score": np.float64})
                if len(ids):
                    yield home(place=block + np.arange(len(ids)), ids=ids, tokens=tokens, known=known, base=base, score=score)
        if not found:
            return
        word, context, after, place, at, block = (np.concatenate([f.pop(0) for f in found]) for _ in range(6))
        trained = (place & 1).astype(np.int64)
        count = np.zeros(len(word), dtype=np.int64)
        logs = np.zeros(len(word))
        token = block + (at >> 1)
        # All entries of a word are in one group, so groups are independent; they bound the memory.
        groups = -(-len(word) // GROUP_ENTRIES)
        group = part_of(mix(word), groups)
        by_group = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[by_group], np.arange(groups + 1))
        del group
        seen_numbers = model.contexts(1)[0]
        for g in range(groups):
            own = by_group[cuts[g] : cuts[g + 1]]
            own = own[np.lexsort((context[own], word[own]))]
            counts = word_counts(model, 1, word[own], trained[own])
            count[own] = counts
            pair = pairs_of(word[own], context[own], trained[own])
            apart = (word[own] >= NUMBERS) & (context[own] >= NUMBERS)
            here = own[~apart]
            logs[here] = model.chance(pair[~apart], counts[~apart], seen_numbers[context[here].astype(np.int64)])
            order = np.argsort(token[own[apart]])
            yield home(asked=token[own[apart]][order], own=counts[apart][order], pair=pair[apart][order])
            tells = own[(at[own] & 1) == 1]
            tells = tells[np.argsort(token[tells], kind="stable")]
            yield home(told=token[tells] + 1, seen=count[tells])
            takes = own[after[own] != NO_WORD]
            takes = takes[np.lexsort((after[takes], word[takes]))]
            pair = pairs_of(word[takes], after[takes], trained[takes])
            logs[takes] += model.chance(pair, model.counts[1][after[takes].astype(np.int64)], count[takes])
        del by_group, context, after, at, token, trained
        rare = word >= NUMBERS
        at = block + (place >> 1)
        order = np.argsort(at, kind="stable")
        at, logs, count, rare = at[order], logs[order], count[order], rare[order]
        firsts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        yield home(
            place=at[firsts], ids=np.full(len(firsts), NO_ID), tokens=np.zeros(len(firsts), dtype=np.int64),
            known=np.add.reduceat((rare & (count > 0)).astype(np.int64), firsts),
            base=np.add.reduceat(np.where(rare, model.base(count), 0.0), firsts), score=np.add.reduceat(logs, firsts),
        )

    def pairs_of(one: np.ndarray, other: np.ndarray, trained: np.ndarray) -> np.ndarray:
        """How often each of the sorted pairs is trained on."""
        new = np.ones(len(one), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (other[1:] != other[:-1])
        firsts = np.flatnonzero(new)
        return np.add.reduceat(trained, firsts)[np.cumsum(new) - 1] if len(firsts) else trained

    def home(**arrays: np.ndarray) -> pa.RecordBatch:
        """Sums and counts go, packed, to where all those of the texts of one task meet; the first array says which task."""
        return packed(list(dealt((next(iter(arrays.values())) >> 32) % parts, parts, arrays)), summed_names)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, tokens, known, base, score, asked, own, pair, told, seen = gathered(batches, kinds)
        order = np.argsort(place, kind="stable")
        place = place[order]
        firsts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
        if len(firsts):
            ids = np.maximum.reduceat(ids[order], firsts)
            tokens, known, base, score = (np.add.reduceat(c[order], firsts) for c in (tokens, known, base, score))
            # Where each text's tokens begin among those of its task.
            block = place[firsts] >> 32
            starts = np.cumsum(tokens) - tokens
            starts += (block << 32) - starts[np.searchsorted(block, block)]
            order = np.argsort(asked)
            asked, own, pair = asked[order], own[order], pair[order]
            order = np.argsort(told)
            if not np.array_equal(told[order], asked):
                raise ValueError("counts of contexts are missing")
            score = score + np.bincount(np.searchsorted(starts, asked, "right") - 1, model.chance(pair, own, seen[order]), len(score))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == NO_ID), *[pa.array(c) for c in (tokens, known, base, score)]],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    kinds = {
        "place": np.int64, "ids": np.int64, "tokens": np.int64, "known": np.int64, "base": np.float64, "score": np.float64,
        "asked": np.int64, "own": np.int64, "pair": np.int64, "told": np.int64, "seen": np.int64,
    }
    summed_names = ["part", *kinds]
    return (
        docs.mapInArrow(send, shape_of(names))
        .repartitionById(parts, F.col("part"))
        .mapInArrow(answer, shape_of(summed_names))
        .repartitionById(parts, F.col("part"))
        .mapInArrow(total, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    )


def score_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", parts: int | None = None
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of the text, A-Z as a-z, and one end.  Documents whose
    id's crc32 leaves 1 modulo 5 are held out and only scored.  Of the others,
    those that leave 0 are the held-out counts on which the mixture weights are
    learned; the counts that score are those of all training documents.
    ``base_score`` is the unigram score with half a count added, ``score`` the
    model's log10 probability of the text.

    Three passes over the texts: word counts, pair counts with the histogram
    for the weights, and scores.  In the last one a token meets the counts of
    its word and pair where those are counted, and only sums per text go on, with
    the counts of the tokens whose word and context both are not frequent.
    ``parts`` (default: the session's shuffle partitions) divides the tokens; a
    task holds one part.

    A NULL or empty text is one token, its end.  A NULL id counts as no text and is
    trained on.  Repeated rows are trained on and scored each.  Without training documents
    ``base_score`` is 0 and every token counts with probability 0.1 in ``score``.  No rows give no rows.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5
    source = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.when(rest == 1, ROLE_NONE).when(rest == 0, ROLE_HELD).otherwise(ROLE_COUNTED).alias("role"),
    )
    model = count_words(source, parts)
    learn_weights(source, model, parts)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return score_tokens(source, model, parts).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(model.tokens[1])).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op6_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by pairs of words."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
