"""Exact copies by radix partitioning from the first byte on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.tables import stored
from tallywood.llm.text import lower_ascii

FIRST_BYTES, GROWTH = 64, 16


def exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are, after A-Z became a-z; a NULL text is
    empty.  ``keep_id`` is the largest id of the equal texts.

    A radix tree from the first byte on: each level takes the next bytes of
    every text still open (64, then 16 times as many with each level, so that
    the number of levels grows with the logarithm of the longest text), splits
    the nodes by them, and is done with nodes that hold one text and with
    texts that have ended.  Only the others go on, with the bytes not yet
    seen.  Equality follows from the bytes; the digest is only reported.

    Nodes are counted with partial sums, so a node may hold any share of the
    rows.  Then nodes of several texts are joined to the open texts; the nodes
    are a table of their own, so that Spark can split a node's texts over
    tasks.  Each level is written once, and recovers from there.

    Rows with a NULL id take part: if no copy has an id, ``keep_id`` is NULL
    and all of them are kept, since nothing tells them apart; so are repeated
    rows with the largest id.  No rows give no rows.  Other columns are not
    read.
    """
    body = lower_ascii(F.coalesce(F.col(text_column), F.lit(""))).cast("binary")
    left = docs.select(
        F.col(id_column).alias("doc_id"),
        F.lit(0).cast("bigint").alias("node"),
        body.alias("rest"),
    ).withColumn("text_sha256", F.sha2("rest", 256))
    width, done = first_bytes, []
    while True:
        cut = left.withColumns(
            {
                "digits": F.substring("rest", 1, width),
                "ended": F.octet_length("rest") <= width,
            }
        )
        nodes = stored(
            cut.groupBy("node", "digits", "ended")
            .agg(F.count("*").alias("size"), F.max("doc_id").alias("keep_id"))
            .where("size > 1")
            .withColumn("child", F.monotonically_increasing_id()),
            "radix-nodes",
        )
        going_on = F.col("size").isNotNull() & ~F.col("ended")
        level = stored(
            # Never a broadcast: the nodes grow with the input.
            cut.join(nodes.hint("merge"), ["node", "digits", "ended"], "left").select(
                "doc_id",
                "text_sha256",
                F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("size", F.lit(1)).alias("group_size"),
                F.when(going_on, F.col("child")).alias("node"),
                F.when(
                    going_on, F.expr(f"substring(rest, {width + 1})")
                ).alias("rest"),
            ),
            "radix-level",
        )
        done.append(level.where("node is null"))
        left = level.where("node is not null").select("doc_id", "node", "rest", "text_sha256")
        if left.isEmpty():
            break
        width = min(width * growth, 2**31 - 1)
    return reduce(DataFrame.union, done).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def op9_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the copy that stays."""
    return exact_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
"""
