"""Sources mixed to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.prefix import hash_piece, piece_bits, running_totals
from tallywood.llm.tables import stored
from tallywood.llm.text import word_count

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
SLOTS, LEAST_BLOCK, CELLS, CHUNK, SEED = 1 << 18, 16, 4096, 4096, 17
ROWS_PER_PIECE = 50_000
# The golden ratio's fraction as a whole number of 2**32nds.
GOLDEN, FULL_TURN = 2654435769, 1 << 32


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``sources`` (``source_key, source_size``) plus ``weight, target, lo, hi``.

    Weights repeat along the sources by code point, NULL last.  A target is
    ``level * weight`` but at most ``most`` times its source's size; ``level``
    is the one at which all targets add up to ``share`` of all sizes, which is
    where sharing the excess out again and again ends.  ``lo`` to ``hi`` is the
    source's part of the line from 0 to 1.  One row per source.
    """
    every = Window.partitionBy()
    by_name = every.orderBy(F.col("source_key.missing"), F.col("source_key.name"))
    by_fill = every.orderBy("fills_at", "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    up_to = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = by_name.rowsBetween(Window.unboundedPreceding, -1)
    choices = F.array(*[F.lit(float(w)) for w in weights])
    return (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumns(
            {
                "weight": F.element_at(choices, (F.col("place") - 1) % len(weights) + 1),
                "cap": F.col("source_size") * F.lit(most),
                "wanted": F.sum("source_size").over(every) * F.lit(share),
            }
        )
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn(
            "level",
            (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(onward),
        )
        .withColumn(
            "level",
            F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "place", "level")))
            .over(every)
            .getField("level"),
        )
        .withColumn(
            "target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
        )
        .withColumn("all_targets", F.greatest(F.sum("target").over(every), F.lit(1e-9)))
        .withColumn("hi", F.sum("target").over(up_to) / F.col("all_targets"))
        .withColumn(
            "lo", F.coalesce(F.sum("target").over(so_far), F.lit(0.0)) / F.col("all_targets")
        )
        .select("source_key", "source_size", "weight", "target", "lo", "hi")
    )


def van_der_corput(number: Column) -> Column:
    """The binary van der Corput point, from 0 to 1, of a whole number below 2**32."""
    turned = F.reverse(F.lpad(F.bin(number), 32, "0"))
    return F.conv(turned, 2, 10).cast("double") / F.lit(float(FULL_TURN))


def schedule(targets: DataFrame, slots: int, block: int, golden: int = GOLDEN) -> DataFrame:
    """``source_key, slot, rank, block_number, take``: which block each slot takes.

    Point k is the fraction of ``(k + 1)`` golden ratios, which fills the line
    from 0 to 1 evenly at every length, and belongs to the source whose part it
    hits.  A source whose part is hit too seldom for its target, as of less
    than a few blocks, gets the slots it lacks where van der Corput points,
    turned by the source's own place on the line, put them among the others.
    A slot's rank among those of its source says which block it takes: the
    source's blocks in turn, then again from the first.  The last slot of a
    source ends at its target; points beyond it take nothing and get no slot.
    Slots are numbered from 0 without gaps.  So every stretch of the schedule
    has the sources near their weights, and a source takes its target without
    the fraction.  Points meet sources by cells of the line, not by comparing
    all with all.
    """
    spark = targets.sparkSession
    point = ((F.col("id") + 1) * F.lit(golden)) % F.lit(FULL_TURN) / F.lit(float(FULL_TURN))
    points = spark.range(slots).select(
        F.col("id").alias("at"), point.alias("point"), F.floor(point * CELLS).alias("cell")
    )
    parts = targets.where("hi > lo").select(
        "source_key",
        "lo",
        "hi",
        F.explode(
            F.sequence(F.floor(F.col("lo") * CELLS), F.floor(F.col("hi") * CELLS))
        ).alias("cell"),
    )
    dealt = points.join(parts, "cell").where("point >= lo and point < hi").select("source_key", "at", F.lit(0).alias("extra"))
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    whole = F.floor("target")
    needed = F.floor(whole / F.col("source_size")) * blocks + F.ceil(whole % F.col("source_size") / F.lit(block))
    spread = van_der_corput(F.col("extra")) + (F.col("lo") + F.col("hi")) / 2
    lacking = (
        targets.where("source_size > 0")
        .join(dealt.groupBy("source_key").agg(F.count("*").alias("hits")), "source_key", "left")
        .withColumns({"hits": F.coalesce("hits", F.lit(0).cast("bigint")), "needed": needed})
        .where("needed > hits")
        .withColumn("extra", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("needed") - F.col("hits"))))
        .select("source_key", F.floor((spread - F.floor(spread)) * slots).alias("at"), "extra")
    )
    placed = dealt.union(lacking).select(
        "*", F.floor(F.col("at") / CHUNK).alias("chunk"), F.lit(1).cast("bigint").alias("one")
    )
    ranked = running_totals(placed, ["source_key"], "chunk", ["at", "extra"], {"rank": "one"})
    start = F.col("block_number") * F.lit(block)
    taking = (
        ranked.join(targets.select("source_key", "source_size", "target"), "source_key")
        .withColumns({"round": F.floor(F.col("rank") / blocks), "block_number": F.col("rank") % blocks})
        .withColumn(
            "take",
            F.least(
                F.lit(block),
                F.col("source_size") - start,
                F.floor("target") - F.col("round") * F.col("source_size") - start,
            ),
        )
        .where("take > 0")
    )
    order = ["at", "extra", "source_key"]
    return running_totals(taking, [], "chunk", order, {"slot": "one"}).select(
        "source_key", "slot", "rank", "block_number", "take"
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    slots: int = SLOTS,
    least_block: int = LEAST_BLOCK,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    rows_per_piece: int = ROWS_PER_PIECE,
    row_column: str | None = None,
    golden: int = GOLDEN,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, first_slot``.

    A source's documents, shuffled by a seeded hash, form one line of words
    that is cut into blocks of equal length; :func:`schedule` deals the slots
    of the mixture to blocks, and ``taken`` counts the words of the document
    that the slots took, repeats included.  ``first_slot`` is the first slot
    that takes words of it, NULL if none does: documents in this order are
    mixed by weight at every length.  ``slots`` sets how fine the mixture
    is at any input size: a block is ``share`` of all words over ``slots``.

    A source takes its target without the fraction, and no document is taken
    more than ``most`` times (rounded up).  A NULL text has no words; NULL sources are one
    source, the last.  A document without words has taken 0.  Equal rows count
    each.  No rows give no rows.  Other columns are not read.

    ``row_column`` may name a column of row numbers: it orders rows alike in all else
    and is returned too.
    """
    missing = F.col(source_column).isNull()
    key = F.struct(missing.alias("missing"), F.coalesce(source_column, F.lit("")).alias("name"))
    measured = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            key.alias("source_key"),
            word_count(F.col(text_column)).alias("size"),
            (F.col(row_column) if row_column else F.monotonically_increasing_id()).alias("row"),
        ),
        "mix-sizes",
    )
    total, rows = measured.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    block = max(least_block, int(-(-total * share // slots)))
    sources = measured.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sources, weights, share, most), "mix-targets")
    dealt = schedule(targets, max(1, int(-(-total * share // block))), block, golden).select(
        "source_key", "slot", "block_number", "take"
    )
    bits = piece_bits(rows, rows_per_piece)
    shuffled = measured.withColumn("mark", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn(
        "piece", hash_piece(F.col("mark"), bits)
    )
    lined = running_totals(shuffled, ["source_key"], "piece", ["mark", "doc_id", "size", "row"], {"start": "size"})
    end = F.col("start") + F.col("size")
    cut = lined.withColumn(
        "block_number",
        F.explode(
            F.sequence(
                F.floor(F.col("start") / F.lit(block)),
                F.floor((F.greatest("start", end - 1)) / F.lit(block)),
            )
        ),
    )
    base = F.col("block_number") * F.lit(block)
    overlap = F.least(end, base + F.coalesce("take", F.lit(0))) - F.greatest(F.col("start"), base)
    taken = (
        cut.join(dealt, ["source_key", "block_number"], "left")
        .groupBy("row", "doc_id", "source_key", "size")
        .agg(
            F.coalesce(F.sum(F.greatest(overlap, F.lit(0))), F.lit(0)).cast("bigint").alias("taken"),
            F.min(F.when(overlap > 0, F.col("slot"))).cast("bigint").alias("first_slot"),
        )
    )
    return taken.join(targets.select("source_key", "source_size", "target"), "source_key").select(
        "doc_id",
        F.when(~F.col("source_key.missing"), F.col("source_key.name")).alias("source"),
        "size",
        "source_size",
        "target",
        "taken",
        "first_slot",
        *([F.col("row").alias(row_column)] if row_column else []),
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by the weights 5, 2, 1."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source")
