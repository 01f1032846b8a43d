"""A corpus made ready for training: documents in, packed batches out.

Each stage gets what the one before it kept.  All but the last return the
columns of ``documents``; the last returns a place in a batch for each row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.exact_dedup import exact_copies
from tallywood.llm.mixing import mix_sources
from tallywood.llm.packing import pack_buckets
from tallywood.llm.partenum import jaccard_components
from tallywood.llm.quality import keep_good
from tallywood.llm.rows import ROW, bitmaps, numbered_rows, pick_rows
from tallywood.llm.tables import stored, stored_alone


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest id.

    Of rows that share it, and of copies without id, the last in the files stays.
    """
    return _picked(spark, docs, _exact_times)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts, that with the smallest id.

    Of rows that share it, the first in the files stays; rows without id only
    where no other of the component has one.  Texts without words all stay.
    """
    return _picked(spark, docs, _near_times)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture takes their words, rounded; those without words once."""
    return _picked(spark, docs, _mix_times)


def _exact_times(numbered: DataFrame) -> DataFrame:
    ids = numbered.select(F.struct("doc_id", ROW).alias("id"), "text")
    return exact_copies(ids, "id").select(F.col(f"doc_id.{ROW}").alias("row"), F.col("kept").cast("int").alias("times"))


def _near_times(numbered: DataFrame) -> DataFrame:
    found = stored(jaccard_components(numbered, id_column=ROW), "pipeline-near").select(
        F.col("doc_id").alias("row"), "component_id"
    )
    ids = numbered.select(F.col(ROW).alias("row"), F.struct(F.isnull("doc_id").alias("missing"), "doc_id", ROW).alias("id"))
    first = found.join(ids, "row").groupBy("component_id").agg(F.min("id").alias("id"))
    return first.select(F.col(f"id.{ROW}").alias("row"), F.lit(1).alias("times"))


def _mix_times(numbered: DataFrame) -> DataFrame:
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5))
    return mix_sources(numbered, row_column=ROW).select(F.col(ROW).alias("row"), times.cast("int").alias("times"))


def _picked(spark: SparkSession, docs: DataFrame, times: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``docs`` as often as ``times`` (``row, times``) says of their numbers.

    Texts stay where they lie, and only the bitmaps remain of the stage's tables.
    """
    numbered = numbered_rows(docs)
    return pick_rows(numbered, stored_alone(spark, lambda: bitmaps(times(numbered)), "pipeline-bitmaps"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A bucket, batch and slot for every document."""
    return pack_buckets(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: The threshold, the similarity join and the schedule are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again.

    What a stage read is deleted once its own rows are written.
    """

    def up_to(count: int) -> DataFrame:
        if not count:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        return stored_alone(spark, lambda: STAGES[count - 1][1](spark, up_to(count - 1), sf_dir), "pipeline")

    return STAGES[-1][1](spark, up_to(len(STAGES) - 1), sf_dir)
