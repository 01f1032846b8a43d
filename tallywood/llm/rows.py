"""Whole rows picked where they lie, by their place in the files they are read from."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.llm.tables import stored

ROW = "__row"
#: Bits of one bitmap: fixed by Spark's bitmap functions, which make 4,096 bytes of them.
BITS = 32_768
#: Bounds of what is sent to every task: 64 MB of bitmaps, and one row for each file.
MOST_BITMAPS, MOST_FILES = 16_384, 1_000_000


def numbered_rows(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__row``, gapless from 0, the same each time the files are read.

    A row's number is its place in its Parquet file behind all rows of the
    files before, by name; so it depends neither on how a scan cuts the files
    nor on the columns read.  A frame that isn't a plain scan of Parquet files
    is stored first.  The rows of each file are counted without reading a
    column.  Up to 1,000,000 files' first numbers are broadcast.  Names that
    begin with two underscores are this module's; any other column is kept.
    """
    try:
        place = docs.metadataColumn("_metadata")
        files = docs.select(place["file_path"].alias("__file"), place["row_index"].alias("__at"))
    except AnalysisException:
        return numbered_rows(stored(docs, "rows"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        files.groupBy("__file")
        .agg(F.count("*").alias("n"))
        .select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("__start")),
        "file-starts",
    )
    if starts.count() <= MOST_FILES:
        starts = F.broadcast(starts)
    return (
        docs.select("*", place["file_path"].alias("__file"), place["row_index"].alias("__at"))
        .join(starts, "__file")
        .withColumn(ROW, F.col("__start") + F.col("__at"))
        .drop("__file", "__at", "__start")
    )


def bitmaps(picked: DataFrame) -> DataFrame:
    """``picked`` (``row, times``) as ``chunk, copy, bits``: a bit for each row that has a copy of that number."""
    copies = picked.where("times > 0").select(
        F.floor(F.col("row") / BITS).alias("chunk"),
        (F.col("row") % BITS).alias("bit"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"),
    )
    # Dealt out by chunk first, so no task holds more than its own bitmaps.
    return copies.repartition("chunk", "copy").groupBy("chunk", "copy").agg(F.bitmap_construct_agg("bit").alias("bits"))


def is_set(bits: str, place: str) -> Column:
    """Is the bit of number ``place`` set in ``bits``, the bitmap of its chunk?"""
    # Fixed layout of Spark's bitmaps: bit k is bit k % 8, from the lowest, of byte k / 8.
    return (
        F.expr(
            f"shiftright(cast(conv(hex(substring({bits}, cast({place} % {BITS} div 8 as int) + 1, 1)), 16, 10) as int),"
            f" cast({place} % 8 as int)) & 1"
        )
        == 1
    )


def pick_rows(numbered: DataFrame, marks: DataFrame, most_bitmaps: int = MOST_BITMAPS) -> DataFrame:
    """Rows of ``numbered`` as often as ``marks`` (see :func:`bitmaps`) say, without their number.

    Up to ``most_bitmaps`` bitmaps are broadcast, and rows are picked where
    they are read: one bit for each row and copy, so 64 MB serve some 500
    million rows.  Beyond, rows meet the bitmaps by chunk, in a shuffle.
    """
    few = marks.count() <= most_bitmaps
    marks = F.broadcast(marks) if few else marks.hint("merge")
    found = numbered.withColumn("__chunk", F.floor(F.col(ROW) / BITS)).join(
        marks.select(F.col("chunk").alias("__chunk"), F.col("bits").alias("__bits")), "__chunk"
    )
    return found.where(is_set("__bits", ROW)).drop("__chunk", "__bits", ROW)
