"""Multi-line log records: continuation lines joined to the stamped line above."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywood.functions import patterns as P
from tallywood.functions.text import starts_with_stamp

#: Most lines of one row of :func:`multiline_records`.
LINES_PER_PART = 10_000
#: Most pieces of files whose places are sent to every task, at some 30 bytes each.
PIECES_TO_SEND = 1_000_000
PIECES = (
    "kind string, piece bigint, file_path string, block bigint, at bigint, part bigint, line bigint,"
    " num_lines bigint, text string, edge string"
)


def _blocks(numbered: DataFrame) -> DataFrame:
    """One row per file and block: its lines, and what comes before it.

    ``before`` is the number of lines in earlier blocks, ``last_at`` the place
    in the block of its last stamped line.  ``carried`` (``pos``) and
    ``carried_line`` (line number) name the stamped line whose record is still
    running when the block begins.
    """
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        numbered.groupBy("file_path", "block")
        .agg(
            F.count("*").alias("num_lines"),
            F.max(F.when(F.col("stamped"), F.col("at"))).alias("last_at"),
            F.max(F.when(F.col("stamped"), F.col("pos"))).alias("last_head"),
        )
        .withColumn("before", F.coalesce(F.sum("num_lines").over(earlier), F.lit(0)))
        .select(
            "file_path",
            "block",
            "num_lines",
            "last_at",
            "before",
            F.last("last_head", ignorenulls=True).over(earlier).alias("carried"),
            F.last(F.col("before") + F.col("last_at"), ignorenulls=True).over(earlier).alias("carried_line"),
        )
    )


def _placed(lines: DataFrame) -> DataFrame:
    """``lines`` plus its place: see :func:`_blocks`, and per line

    ``line`` its number in the file from 1, ``own`` and ``own_line`` the ``pos``
    and number of the stamped line its record begins with, and ``open`` whether
    the record can reach into another block.

    The text moves once, by file and block.  Stamps are looked for behind that
    exchange and not before it, so that the rows per block come from the same
    exchange, and from the same scan, as the lines.
    """
    so_far = Window.partitionBy("file_path", "block").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    numbered = (
        lines.repartition("file_path", "block")
        .withColumn("stamped", F.coalesce(starts_with_stamp(F.col("value")), F.lit(False)))
        .withColumn("at", F.row_number().over(so_far).cast("bigint"))
    )
    stamped, before = F.col("stamped"), F.col("before")
    return (
        numbered.withColumns(
            {
                "head": F.max(F.when(stamped, F.col("pos"))).over(so_far),
                "head_at": F.max(F.when(stamped, F.col("at"))).over(so_far),
            }
        )
        .join(_blocks(numbered), ["file_path", "block"])
        .select(
            *lines.columns,
            "before",
            "num_lines",
            (before + F.col("at")).alias("line"),
            F.coalesce("head", "carried").alias("own"),
            F.coalesce(before + F.col("head_at"), "carried_line").alias("own_line"),
            F.coalesce(F.col("head_at") == F.col("last_at"), F.col("carried").isNotNull()).alias("open"),
        )
    )


def assign_records(lines: DataFrame) -> DataFrame:
    """``lines`` plus ``record``: the ``pos`` of the stamped line each belongs to.

    ``lines`` has ``file_path, block, pos, value``: ``block`` cuts a file into
    ordered pieces of limited size, as a scan does, and ``pos`` (bigint, unique
    within the file) orders the lines of a block.  A line's record is the last
    stamped line at or above it: found inside its block or, failing that,
    carried in from earlier blocks, of which there is one row each.  No task
    has to hold more than a block; a compressed file, which no scan can cut,
    is one block.  Lines above a file's first stamp have no record (NULL).
    """
    return _placed(lines).select(*lines.columns, F.col("own").alias("record"))


def multiline_records(lines: DataFrame, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """``file_path, record, part, num_lines, text``: every record, whole.

    ``lines`` is as in :func:`assign_records`.  ``record`` is the number in the
    file (from 1) of the record's first line.  A record comes in parts of
    ``lines_per_part`` lines, numbered from 0, so that no row grows without
    bound; a record no longer than that is its part 0.  A line above a file's
    first stamp is a record of its own.  The result does not depend on how a
    scan cuts the files.

    The text is read once and shuffled once, by file and block, and parts are
    put together where their lines then are.  Only parts that can reach over
    the edge of a block go through a second, small shuffle.
    """
    line, own_line, before = F.col("line"), F.col("own_line"), F.col("before")
    part = F.coalesce(F.floor((line - own_line) / lines_per_part), F.lit(0)).cast("bigint")
    first = own_line + F.col("part") * lines_per_part
    whole = (first > before) & (first + (lines_per_part - 1) <= before + F.col("num_lines"))
    placed = _placed(lines).withColumn("part", part).select(
        "file_path",
        "block",
        F.coalesce("own_line", "line").alias("record"),
        "part",
        (F.col("open") & ~whole).alias("crosses"),
        F.struct("line", "value").alias("content"),
    )
    content = F.array_sort(F.collect_list("content")).alias("content")
    inside = placed.where(~F.col("crosses")).groupBy("file_path", "block", "record", "part").agg(content).drop("block")
    across = placed.where("crosses").groupBy("file_path", "record", "part").agg(content)
    return inside.union(across).select(
        "file_path",
        "record",
        "part",
        F.size("content").cast("bigint").alias("num_lines"),
        F.array_join(F.col("content.value"), "\n").alias("text"),
    )


def record_pieces(lines: DataFrame, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """What each piece of a scan knows of its records, from one reading: store it for :func:`whole_records`.

    ``lines`` comes from ``read_positioned_log_lines`` with nothing but plain
    projections since: a task then reads each piece of a file from front to
    back, and records are put together where their lines are.  No line moves.

    Rows have ``kind, piece, file_path, block, at, part, line, num_lines, text, edge``,
    with line numbers counted from 1 within the piece and the text of a head
    or tail as ``edge``, so that reading those reads little.  ``inside``: a part of
    the record that begins ``at``, from ``line`` on.  ``tail``: the last part of
    the piece's last record, which may go on in the next piece.  ``head``:
    lines above the piece's first stamp, at most ``lines_per_part``.  ``size``:
    all lines of the piece, and ``at`` its last stamp (0: none).  ``piece`` is
    a 64-bit hash of file and block.
    """
    return lines.select(
        "value", F.xxhash64("file_path", "block").alias("piece"), "file_path", F.col("block").cast("bigint").alias("block")
    ).mapInArrow(
        _piece_rows(lines_per_part), PIECES
    )


def _piece_rows(lines_per_part: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """See :func:`record_pieces`; a task holds the lines of one part besides a batch.

    All pieces of a batch are handled at once, so that many small files cost no more than a large one.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]

    def rows(where: list[pa.Array], kinds: np.ndarray, text: pa.Array | None, *numbers: np.ndarray) -> pa.RecordBatch:
        found = [pa.array(np.asarray(c, dtype=np.int64)) for c in numbers]
        none = pa.nulls(len(kinds), pa.string())
        edges = pa.array((kinds == "head") | (kinds == "tail"))
        texts = [none, none] if text is None else [pc.if_else(edges, none, text), pc.if_else(edges, text, none)]
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), *where, *found, *texts], names=names)

    def joined(values: pa.Array, firsts: np.ndarray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), values), "\n")

    def kinds_of(at: np.ndarray, last: np.ndarray, num_lines: np.ndarray) -> np.ndarray:
        """``last``: of its piece."""
        return np.where(at == 0, "head", np.where(last & (num_lines < lines_per_part), "tail", "inside")).astype(object)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, line, at = None, 0, 0  # of the open piece
        held: list[pa.Array] = []
        key = (0, 0, 0)  # of the held lines: at, part, line

        def flushed(last: bool) -> pa.RecordBatch:
            values = pa.concat_arrays(held)
            kinds = kinds_of(np.array([key[0]]), np.array([last]), np.array([len(values)]))
            return rows(where, kinds, joined(values, np.array([0, len(values)])), *([k] for k in key), [len(values)])

        def sizes(where: list[pa.Array], at: np.ndarray, num_lines: np.ndarray) -> pa.RecordBatch:
            zero = np.zeros(len(at))
            return rows(where, np.full(len(at), "size", dtype=object), None, at, zero, zero, num_lines)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            pieces = batch.column(1).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], pieces[1:] != pieces[:-1]]))
            if held and pieces[0] != where[0][0].as_py():
                yield flushed(last=True)
                yield sizes(where, np.array([at]), np.array([line]))
                line, at, held = 0, 0, []

            def named(rows: np.ndarray) -> list[pa.Array]:
                return [batch.column(i).take(pa.array(rows)) for i in (1, 2, 3)]  # noqa: B023

            values = batch.column(0).fill_null("")
            begin = np.repeat(starts, np.diff([*starts, n]))
            numbers = np.arange(1, n + 1) - begin + np.where(begin == 0, line, 0)
            stamped = pc.match_substring_regex(values, P.STAMP_AT_START).to_numpy(zero_copy_only=False)
            stamp = np.maximum.accumulate(np.where(stamped, np.arange(n), -1))
            owns = np.where(stamp >= begin, numbers[stamp], np.where(begin == 0, at, 0))
            parts = (numbers - np.maximum(owns, 1)) // lines_per_part
            line, at = int(numbers[-1]), int(owns[-1])
            new = np.ones(n, dtype=bool)
            new[1:] = (begin[1:] != begin[:-1]) | (owns[1:] != owns[:-1]) | (parts[1:] != parts[:-1])
            new[0] = not held or (int(owns[0]), int(parts[0])) != key[:2]
            firsts = np.flatnonzero(new)
            if not len(firsts):
                held.append(values)
                continue
            if held:
                held.append(values.slice(0, int(firsts[0])))
                yield flushed(last=int(firsts[0]) in starts[1:])
            if len(firsts) > 1:
                done, num_lines = firsts[:-1], np.diff(firsts)
                kinds = kinds_of(owns[done], np.isin(firsts[1:], starts), num_lines)
                yield rows(named(done), kinds, joined(values, firsts), owns[done], parts[done], numbers[done], num_lines)
            if len(starts) > 1:
                ends = starts[1:] - 1
                yield sizes(named(ends), owns[ends], numbers[ends])
            tail = int(firsts[-1])
            held, key = [values.slice(tail)], (int(owns[tail]), int(parts[tail]), int(numbers[tail]))
            where = named(np.array([tail]))
        if held:
            yield flushed(last=True)
            yield sizes(where, np.array([at]), np.array([line]))

    return assemble


def whole_records(pieces: DataFrame, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """The rows of :func:`multiline_records` from stored :func:`record_pieces` of the same ``lines_per_part``.

    Where a piece begins in its file, and which record is running there,
    follows from one row of each piece.  These rows are sent to every task as
    long as there are no more than ``PIECES_TO_SEND`` (about 128 TB of text at
    Spark's default piece), otherwise they are joined by sorting.  Only heads
    and tails of pieces are shuffled, line by line; all other text stays
    where it was read.
    """
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.where("kind = 'size'")
    last_stamp = F.when(F.col("at") > 0, F.col("before") + F.col("at"))
    places = (
        sizes.withColumn("before", F.coalesce(F.sum("num_lines").over(earlier), F.lit(0)))
        .select("piece", "before", F.last(last_stamp, ignorenulls=True).over(earlier).alias("carried"))
    )
    few = sizes.limit(PIECES_TO_SEND + 1).count() <= PIECES_TO_SEND
    places = places.hint("broadcast" if few else "merge")
    inside = pieces.where("kind = 'inside'").join(places, "piece").select(
        "file_path", (F.col("before") + F.col("at")).alias("record"), "part", "num_lines", "text"
    )
    own = F.when(F.col("kind") == "tail", F.col("before") + F.col("at")).otherwise(F.coalesce("carried", F.col("number")))
    across = (
        pieces.where("edge IS NOT NULL")
        .select("kind", "piece", "file_path", "at", "line", "edge")
        .join(places, "piece")
        .select("*", F.posexplode(F.split("edge", "\n")).alias("i", "value"))
        .withColumn("number", F.col("before") + F.col("line") + F.col("i"))
        .withColumn("record", own)
        .withColumn("part", F.floor((F.col("number") - F.col("record")) / lines_per_part).cast("bigint"))
        .groupBy("file_path", "record", "part")
        .agg(F.array_sort(F.collect_list(F.struct("number", "value"))).alias("content"))
        .select(
            "file_path",
            "record",
            "part",
            F.size("content").cast("bigint").alias("num_lines"),
            F.array_join("content.value", "\n").alias("text"),
        )
    )
    return inside.union(across)
