"""Words of many texts at once, as arrays of hashes.

Everything works on the bytes of a slice of texts, so no step runs once per
text or per word.  A slice holds at most ``SLICE_BYTES`` bytes, or one longer
text; memory is about 60 bytes for each of them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: Powers are made so many at a time.
POWERS = 1 << 16
U = np.uint64
# Odd multipliers of the hashes; any would do.
BASE, STEP, LENGTH = U(0x9FB21C651E98DF25), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)
MIX_1, MIX_2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
#: Space and the five controls from tab to carriage return.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = []
Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where the allocator can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(task: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``task`` for ``mapInArrow``, after which its Python worker, kept idle for the next one, does not hold what it needed at most."""

    def run(batches: Batches) -> Batches:
        yield from task(batches)
        give_back()

    return run


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    values = (values ^ (values >> U(30))) * MIX_1
    values = (values ^ (values >> U(27))) * MIX_2
    return values ^ (values >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``BASE`` and of its inverse; kept between calls."""
    if not _powers or len(_powers[0]) < n:
        made = []
        for base in (BASE, BASE_INVERSE):
            steps = np.full(-(-n // POWERS) * POWERS, base, dtype=U)
            steps[0] = 1
            made.append(np.cumprod(steps))
        if n > 4 * SLICE_BYTES:  # of one very long text; not kept
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


class SpanHasher:
    """Hashes of any byte spans of a buffer from one running sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(U) * LENGTH)


@dataclass
class Slice:
    """Some rows of a batch: ``data`` holds their texts, cut by ``offsets``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive rows of ``texts``; NULL is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = texts.cast(pa.large_string()).fill_null("")
    buffers = plain.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(plain):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(plain))
        low, high = offsets[first], offsets[last]
        yield Slice(first, data[low:high], offsets[first : last + 1] - low)
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, no other byte changed."""
    return np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)


def runs(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of kept bytes; runs end with their text."""
    if not len(keep):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    before = np.concatenate([[False], keep[:-1]])
    cuts = offsets[offsets < len(keep)]
    before[cuts] = False
    starts = np.flatnonzero(keep & ~before)
    after = np.concatenate([keep[1:], [False]])
    after[cuts[cuts > 0] - 1] = False
    return starts, np.flatnonzero(keep & ~after) + 1


@dataclass
class Words:
    """Words of a slice: hash, row within the slice, and where each row's words begin."""

    hashes: np.ndarray
    rows: np.ndarray
    firsts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)


def words_of(part: Slice, lower: bool) -> Words:
    data = lowered(part.data) if lower else part.data
    starts, ends = runs(~IS_SPACE[data], part.offsets)
    rows = np.searchsorted(part.offsets, starts, "right") - 1
    firsts = np.searchsorted(starts, part.offsets)
    return Words(SpanHasher(data)(starts, ends), rows, firsts, starts, ends)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each window of ``size`` words of one text begins, and its hash."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    at = np.flatnonzero(words.rows[:n] == words.rows[size - 1 :])
    total = np.zeros(len(at), dtype=U)
    for i in range(size):
        total = total * STEP + words.hashes[at + i]
    return at, mix(total + U(size * int(LENGTH) % (1 << 64)))


def sums_by_row(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each row, where row i has those from firsts[i] on."""
    total = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(values, dtype=np.int64)])
    return np.diff(total[firsts])
