"""Periodic runs of words, found in tiles of every scale and stitched by document and period.

A run of period q holds the words i with word i equal to word i + q, without a
gap, and the q words after them; those i are called its *matches*.  Periods P
to 2P - 1, P a power of two, are an octave.  A long enough run of the octave
has at least 3P matches, so a tile border every 3P words hits each of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.tables import stored
from tallywood.llm.words import BASE, U, powers, slices, words_of

LEAST_WORDS, EXPONENT = 6, 4  # shortest run in words and in periods
PAIRS_AT_ONCE = 1 << 20
SOLVED = (
    "doc_id bigint, row_key binary, body binary, collapsed_sha256 string, period bigint, first bigint, last bigint"
)
FOUND = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers that a text of ``n`` words is read as, or None for its own ones."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


class Spans:
    """Equality of spans of words by hashes from one running sum."""

    def __init__(self, words: np.ndarray):
        self.up, _ = powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, dtype=U)
        np.cumsum((words | U(1)) * self.up[: len(words)], out=self.sums[1:])

    def equal(self, at: np.ndarray, shift: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``at`` on equal those ``shift`` later."""
        here = self.sums[at + n] - self.sums[at]
        return here * self.up[shift] == self.sums[at + shift + n] - self.sums[at + shift]

    def matches(self, border: np.ndarray, shift: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
        """Z-values: words in a row from ``border`` on (or before it) that equal those ``shift`` later."""
        n = np.zeros(len(border), dtype=np.int64)
        step = 1 << int(room.max(initial=1)).bit_length()
        while step := step >> 1:
            fits = np.flatnonzero(n + step <= room)
            start = border[fits] - n[fits] - step if back else border[fits] + n[fits]
            n[fits] += step * self.equal(start, shift[fits], np.full(len(fits), step))
        return n


def prime_steps(periods: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each prime divisor of each period: which period, and the period divided by it."""
    left, at = periods.copy(), np.arange(len(periods))
    prime = 2
    while len(at):
        if prime * prime > left.max():
            rest = left > 1
            yield at[rest], periods[at[rest]] // left[rest]
            return
        hit = left % prime == 0
        if hit.any():
            yield at[hit], periods[at[hit]] // prime
            while hit.any():
                left[hit] //= prime
                hit = left % prime == 0
        keep = left > 1
        at, left = at[keep], left[keep]
        prime += 1


def solve_octave(words: np.ndarray, spans: Spans, firsts: np.ndarray, base: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``row, period, first match, last match + 1`` of each fragment in each tile of an octave.

    ``firsts`` says where each row's words begin in ``words``.  A tile reaches
    3 * ``base`` matches to both sides of its border, so that tiles overlap:
    a fragment that fills its tile to one side meets that of the next tile.
    Fragments are left out if they end inside the tile and are too short, or
    if their words have a shorter period (a fragment is at least twice its
    period long, so then the whole run has that period).
    """
    counts = np.diff(firsts)
    stride = 3 * base
    rows = np.flatnonzero(counts >= max(LEAST_WORDS, EXPONENT * base))
    tiles = -(-(counts[rows] - base) // stride)
    tile_row = np.repeat(rows, tiles)
    number = np.arange(len(tile_row)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
    borders = firsts[tile_row] + number * stride
    at_once = max(1, PAIRS_AT_ONCE // base)
    for a in range(0, len(borders), at_once):
        border, row = borders[a : a + at_once], tile_row[a : a + at_once]
        for low in range(base, 2 * base, PAIRS_AT_ONCE):
            shifts = np.arange(low, min(2 * base, low + PAIRS_AT_ONCE))
            other = border[:, None] + shifts
            inside = other < firsts[row + 1][:, None]
            hit, column = np.nonzero(inside & (words[np.where(inside, other, 0)] == words[border][:, None]))
            b, q, r = border[hit], shifts[column], row[hit]
            fits = EXPONENT * q <= counts[r]
            b, q, r = b[fits], q[fits], r[fits]
            before, after = b - firsts[r], firsts[r + 1] - q - b
            right = spans.matches(b, q, np.minimum(stride, after), back=False)
            left = spans.matches(b, q, np.minimum(stride, before), back=True)
            cut = ((right == stride) & (after > stride)) | ((left == stride) & (before > stride))
            keep = np.flatnonzero(cut | (left + right + q >= np.maximum(LEAST_WORDS, EXPONENT * q)))
            b, q, r, left, right = (x[keep] for x in (b, q, r, left, right))
            shorter = np.zeros(len(b), dtype=bool)
            for i, step in prime_steps(q):
                shorter[i] |= spans.equal(b[i] - left[i], step, 2 * q[i] - step)
            b, q, r, left, right = (x[~shorter] for x in (b, q, r, left, right))
            yield r, q, b - left - firsts[r], b + right - firsts[r]


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, with its words if it has fragments, and one for each fragment."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for part in slices(batch.column(1)):
            found = words_of(part, lower=False)
            words, bodies = found.hashes.copy(), []
            for i in range(len(part)):
                body = part.data[part.offsets[i] : part.offsets[i + 1]].tobytes().split()
                order = planted(ids[part.first + i], len(body))
                if order is not None:
                    words[found.firsts[i] : found.firsts[i + 1]] = words[found.firsts[i] + order]
                    body = [body[j] for j in order]
                bodies.append(b" ".join(body))
            spans, longest = Spans(words), int(found.counts.max(initial=0))
            octaves = [1 << k for k in range(64) if max(LEAST_WORDS, EXPONENT << k) <= longest]
            fragments = [f for base in octaves for f in solve_octave(words, spans, found.firsts, base)]
            row, period, first, last = (
                (np.concatenate(c) for c in zip(*fragments)) if fragments else [np.zeros(0, dtype=np.int64)] * 4
            )
            hit = np.zeros(len(part), dtype=bool)
            hit[row] = True
            mine = [ids[part.first + i] for i in range(len(part))]
            keys = [
                hashlib.blake2b(f"{mine[i]}:".encode() + bodies[i], digest_size=16).digest() if hit[i] else None
                for i in range(len(part))
            ]
            n, m = len(part), len(row)
            columns = [
                pa.array(mine + [None] * m, pa.int64()),
                pa.array(keys + [keys[i] for i in row], pa.binary()),
                pa.array([b if h else None for b, h in zip(bodies, hit)] + [None] * m, pa.binary()),
                pa.array(
                    [None if h else hashlib.sha256(b).hexdigest() for b, h in zip(bodies, hit)] + [None] * m, pa.string()
                ),
                *[pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c, pa.int64())]) for c in (period, first, last)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SOLVED.split(", ")])


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result row of each document: its best run, and digests of its runs and of the words that stay."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            runs = row["runs"] or []
            digest = row["collapsed_sha256"]
            if digest is None:
                words = row["body"].split(b" ")
                drop = np.zeros(len(words) + 1, dtype=np.int64)
                for start, length, period in ((r["start"], r["length"], r["period"]) for r in runs):
                    drop[start + period] += 1
                    drop[start + length] -= 1
                kept = [w for w, d in zip(words, np.cumsum(drop)) if not d]
                digest = hashlib.sha256(b" ".join(kept)).hexdigest()
            best = min(runs, key=lambda r: (-r["length"], r["start"], r["period"]), default=None)
            listed = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
            out.append(
                {
                    "doc_id": row["doc_id"],
                    "n_runs": len(runs),
                    "start": best and best["start"],
                    "length": best and best["length"],
                    "period": best and best["period"],
                    "exponent_milli": best and 1000 * best["length"] // best["period"],
                    "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                    "collapsed_sha256": digest,
                }
            )
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in FOUND.split(", ")]
        names = [c.split()[0] for c in FOUND.split(", ")]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(list(zip(names, kinds))))


def stitch(fragments: DataFrame) -> DataFrame:
    """``row_key, start, length, period`` of all runs, from fragments ``row_key, period, first, last``.

    Fragments of one document and period that overlap are one run.  Such a
    group holds at most a row for each tile of one document.
    """
    ordered = Window.partitionBy("row_key", "period").orderBy("first", "last")
    reached = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= reached, 0).otherwise(1)
    least = F.greatest(F.lit(LEAST_WORDS), F.col("period") * EXPONENT)
    return (
        fragments.withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(ordered))
        .groupBy("row_key", "period", "run")
        .agg(F.min("first").alias("start"), F.max("last").alias("end"))
        .select("row_key", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
        .where(F.col("length") >= least)
    )


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``.

    A run is a stretch of words with smallest period q and at least
    max(6, 4 * q) words that no word before or after extends.  Documents whose
    id has a CRC-32 divisible by 10 are read with a repeated passage, see
    :func:`planted`.  The best run is the longest (then that with the smallest
    start, then period); words after the first q of any run are dropped from
    the text that ``collapsed_sha256`` is of.

    Documents become tiles where they are read; a tile of an octave is three
    of its least periods wide to both sides of a border, overlaps the next
    ones, and is solved alone: forward and backward Z-values at its border for
    each period of the octave.  Only fragments of runs are shuffled, by document
    and period, and stitched, and only documents with fragments are read again.
    A document of n words costs about n / 3 comparisons for each of log2(n)
    octaves, also if it is one word repeated.

    Words and spans are told apart by hashes of 64 bits.  A NULL or empty text
    has no words and no runs; a NULL id is never planted; repeated rows get a
    row each, equal ones; no rows give no rows.  Other columns are not read.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    solved = stored(source.mapInArrow(solve, SOLVED), "runs-solved")
    runs = (
        stitch(solved.where("period is not null").select("row_key", "period", "first", "last"))
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    )
    documents = solved.where("period is null").select("doc_id", "row_key", "body", "collapsed_sha256")
    none = F.lit(None).cast("array<struct<start:bigint,period:bigint,length:bigint>>").alias("runs")
    plain = documents.where("row_key is null").select("doc_id", "body", "collapsed_sha256", none)
    with_runs = (
        documents.where("row_key is not null").join(runs, "row_key", "left").select("doc_id", "body", "collapsed_sha256", "runs")
    )
    return plain.union(with_runs).mapInArrow(collapse, FOUND)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their periodic runs."""
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
