"""Length buckets of least padding, and token-budget batches inside them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.prefix import hash_piece, piece_bits, running_totals
from tallywood.llm.tables import stored
from tallywood.llm.text import word_count

BUCKETS, BUDGET, FINE_BITS, SEED = 16, 65_536, 16, 23
ROWS_PER_PIECE = 50_000


def grain(length: Column, fine_bits: int) -> Column:
    """``length`` rounded up to ``fine_bits`` leading binary digits.

    At most ``2**fine_bits`` lengths of each power of two stay apart, so the
    histogram is bounded by the longest text's digits and not by the input.
    Lengths below ``2**fine_bits`` stay exact.
    """
    digits = F.length(F.bin(length))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(digits - fine_bits, F.lit(0)))
    return F.floor((length + step - 1) / step) * step


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` ranges of ``lengths`` (ascending) with least padding.

    Dynamic programming: ``cost[j]`` is the least number of tokens, padding
    included, for the first j lengths with the ranges used so far; a range
    from i to j pads all its texts to length j.  Over j that is the lowest of
    lines, one for each i, with ever lower slopes at ever larger places; so
    lines that can't be lowest again are dropped, and a round of all j takes
    time in proportion to their number.
    """
    n = len(lengths)
    if not n:
        return []
    texts = [0, *accumulate(counts)]
    cost = [0, *[w * t for w, t in zip(lengths, texts[1:])]]
    choices = [[0] * (n + 1)]
    for _ in range(1, min(buckets, n)):
        new, choice, lines, first = cost[:], [0] * (n + 1), [], 0
        for j in range(1, n + 1):
            added = j - 1
            while len(lines) - first > 1:
                one, two = lines[-2], lines[-1]
                meets_two = (cost[added] - cost[one]) * (texts[two] - texts[one])
                if meets_two > (cost[two] - cost[one]) * (texts[added] - texts[one]):
                    break
                lines.pop()
            lines.append(added)
            at = lengths[j - 1]
            while len(lines) - first > 1 and cost[lines[first + 1]] - cost[lines[first]] <= at * (texts[lines[first + 1]] - texts[lines[first]]):
                first += 1
            i = lines[first]
            new[j], choice[j] = cost[i] + at * (texts[j] - texts[i]), i
        cost = new
        choices.append(choice)
    ends, j = [], n
    for choice in reversed(choices):
        if j:
            ends.append(lengths[j - 1])
            j = choice[j]
    return sorted(ends)


def pack_buckets(
    docs: DataFrame,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    fine_bits: int = FINE_BITS,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, bucket, bucket_tokens, batch, slot, padding``.

    The histogram of all lengths (words; one more token ends a text) chooses
    the bucket boundaries with the least padding.  Lengths below
    ``2**fine_bits`` are told apart one by one; longer ones may share a cell
    of the histogram, at most ``2**(1 - fine_bits)`` of their length wide, and
    count as the longest text in it.  A bucket is as wide as its longest text.  Inside its bucket, in
    seeded random order, a document gets the next place of a batch; a batch
    holds as many texts, padded to the bucket's length, as ``budget`` tokens
    allow, and a text longer than the budget makes a batch of its own.
    ``batch`` numbers the batches of a bucket.

    A NULL or empty text has one token, its end.  Equal rows get places of their own.  No
    rows give no rows.  Other columns are not read.
    """
    measured = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (word_count(F.col(text_column)) + 1).alias("n_tokens"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pack-lengths",
    ).withColumn("rounded", grain(F.col("n_tokens"), fine_bits))
    # Bounded: 2**fine_bits lengths, and half as many for each further binary digit of the longest text.
    histogram = (
        measured.groupBy("rounded").agg(F.max("n_tokens").alias("longest"), F.count("*").alias("n")).orderBy("rounded").collect()
    )
    counts = [r["n"] for r in histogram]
    ends = best_boundaries([r["longest"] for r in histogram], counts, buckets)
    which = F.lit(0)
    for end in ends[:-1]:
        which = which + (F.col("n_tokens") > end).cast("int")
    width = F.element_at(F.array(*[F.lit(e).cast("bigint") for e in ends or [1]]), F.col("bucket") + 1)
    bits = piece_bits(sum(counts), rows_per_piece)
    placed = running_totals(
        measured.withColumns(
            {
                "bucket": which,
                "mark": F.xxhash64(F.lit(seed), "doc_id", "n_tokens"),
                "one": F.lit(1).cast("bigint"),
            }
        ).withColumn("piece", hash_piece(F.col("mark"), bits)),
        ["bucket"],
        "piece",
        ["mark", "doc_id", "n_tokens", "row"],
        {"place": "one"},
    )
    return (
        placed.withColumn("bucket_tokens", width)
        .withColumn("holds", F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens"))))
        .select(
            "doc_id",
            "n_tokens",
            "bucket",
            "bucket_tokens",
            F.floor(F.col("place") / F.col("holds")).alias("batch"),
            (F.col("place") % F.col("holds")).cast("int").alias("slot"),
            (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
        )
    )


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in batches of 65,536 tokens."""
    return pack_buckets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
