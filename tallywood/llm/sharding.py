"""Contiguous shards of near-equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.prefix import running_totals
from tallywood.llm.tables import stored

ROWS_PER_PIECE = 50_000


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Documents are put in order of id and the line of their bytes is cut at
    equal targets; a document goes where its middle falls, so every shard is a
    run of ids and misses the target by less than one document.  ``slot``
    numbers the documents of a shard from 0.  ``grown_shard`` belongs to
    another law and is NULL.

    Only ids, sizes and checksums are sorted, by range over many tasks, and
    kept in a table; each range gives one total, and the running sum of those
    totals gives every range its start.

    A NULL or empty text has size 1 and checksum 0.  NULL ids come first;
    repeated ids are ordered by checksum and size, equal rows at random but
    fixed.  No rows give no rows.  Other columns are not read.
    """
    body = F.coalesce(F.col(text_column), F.lit(""))
    measured = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(body).cast("bigint") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-sizes",
    )
    total, rows = measured.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    order = ["doc_id", "text_crc32", "size", "row"]
    pieces = max(1, -(-rows // rows_per_piece))
    ordered = stored(
        measured.repartitionByRange(pieces, *order).withColumns(
            {"piece": F.spark_partition_id(), "one": F.lit(1).cast("bigint")}
        ),
        "shard-order",
    )
    placed = running_totals(
        ordered, [], "piece", order, {"bytes_before": "size", "rows_before": "one"}
    )
    # Twice the middle against twice the total, all in whole numbers.
    middle = (2 * F.col("bytes_before") + F.col("size")) * F.lit(shards).cast("bigint")
    cut = placed.withColumns({"target": F.lit(max(1, 2 * total)), "middle": middle}).withColumn(
        "shard", F.least(F.expr("middle div target").cast("int"), F.lit(shards - 1))
    )
    firsts = cut.groupBy("shard").agg(F.min("rows_before").alias("first_row"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rows_before") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards."""
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
