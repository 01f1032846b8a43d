"""Trip records and other parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def monthly_paths(template: str, months: Iterable[int], year: int) -> list[str]:
    """One path per month, e.g. from ``"{year}/trips_{year}-{month:02d}.parquet"``."""
    return [template.format(year=year, month=month) for month in months]


def read_tables(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Several parquet paths as one table; a path given twice is read twice."""
    return spark.read.parquet(*paths)


def read_partitioned(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """A glob below ``root``, with ``key=value`` folder names as columns.

    Filters on those columns prune folders before anything is read.
    """
    return spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/{pattern}")


def read_months(spark: SparkSession, root: str, year: int, months: Iterable[int]) -> DataFrame:
    """Some months of a table stored in ``year=``, ``month=`` folders; other folders are not read.

    A month without a folder has no rows.
    """
    table = spark.read.parquet(root)
    return table.where((F.col("year") == year) & F.col("month").isin(*months))


def profile_columns(df: DataFrame) -> DataFrame:
    """``position, column_name, column_type, num_rows, num_nulls`` of ``df``, from one aggregation."""
    fields = df.schema.fields
    counts = df.agg(F.count("*").alias("num_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    columns = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("num_rows"),
            (F.col("num_rows") - F.col(f"c{i}")).alias("num_nulls"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*columns)))


def describe_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``position, column_name, column_type, nullable`` of ``df``; reads no rows."""
    rows = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "position int, column_name string, column_type string, nullable boolean"
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """Some rows of a source, as its first partitions hold them."""
    return df.limit(rows)


def even_ids_doubled(ids: DataFrame, column: str = "id") -> DataFrame:
    """Twice every even id: the filter-and-project step of an install check."""
    key = F.col(column)
    return ids.where(key % 2 == 0).select((key * 2).alias("doubled"))


def view_row_count(df: DataFrame, view: str) -> DataFrame:
    """Register ``df`` as a temporary view and count its rows with SQL text."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(
        "SELECT count(*) AS total FROM IDENTIFIER(:view)", args={"view": view}
    )
