"""Daily summaries of trip records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TripColumns:
    """Where a trip table keeps what the summary reads."""

    pickup: str = "tpep_pickup_datetime"
    distance: str = "trip_distance"
    tax: str = "mta_tax"
    fare: str = "fare_amount"
    tip: str = "tip_amount"
    passengers: str = "passenger_count"


def in_year(trips: DataFrame, column: str, year: int) -> Column:
    """Whether ``column`` falls in ``year``, as a range on the stored value.

    ``year(column) = y`` cannot reach a parquet scan; this range can, and skips
    row groups by their statistics.  NULL times drop out either way.
    """
    kind = trips.schema[column].dataType

    def first_day(y: int) -> Column:
        return F.lit(f"{y:04d}-01-01").cast("date").cast(kind)

    return (F.col(column) >= first_day(year)) & (F.col(column) < first_day(year + 1))


def daily_summary(
    trips: DataFrame,
    year: int,
    columns: TripColumns = TripColumns(),
    accuracy: int = 10_000,
) -> DataFrame:
    """Six metrics for each calendar day of ``year``, latest day first.

    The 95th percentile is a mergeable sketch of bounded size whose rank error
    is at most ``1 / accuracy``: a day with a third of all trips is reduced in
    many tasks, and no day's values ever have to meet in one.
    """
    c = columns
    day = F.col("day")
    return (
        trips.where(in_year(trips, c.pickup, year))
        .groupBy(F.to_date(c.pickup).alias("day"))
        .agg(
            F.count("*").alias("num_trips"),
            F.avg(c.distance).alias("mean_trip_distance"),
            F.max(c.tax).alias("max_mta_tax"),
            F.percentile_approx(c.fare, 0.95, accuracy).alias("q95_fare_amount"),
            F.min(c.tip).alias("min_tip_amount"),
            F.ceil(F.avg(c.passengers)).alias("mean_passenger_count"),
        )
        .select(
            F.year(day).alias("dt_year"),
            F.month(day).alias("dt_month"),
            F.dayofmonth(day).alias("dt_day"),
            "num_trips",
            "mean_trip_distance",
            "max_mta_tax",
            "q95_fare_amount",
            "min_tip_amount",
            "mean_passenger_count",
        )
        .orderBy(F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day"))
    )


def daily_rollup(daily: DataFrame) -> DataFrame:
    """One row over the daily table: days, trips, trips per day, date range."""
    date = F.make_date("dt_year", "dt_month", "dt_day")
    return daily.agg(
        F.count("*").alias("num_days"),
        F.coalesce(F.sum("num_trips"), F.lit(0)).alias("total_trips"),
        F.try_divide(F.sum("num_trips"), F.count("*")).alias("mean_daily_trips"),
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
    )


def top_days(daily: DataFrame, rows: int = 20) -> DataFrame:
    """The latest days of the daily table."""
    return daily.orderBy(F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day")).limit(rows)


def trip_totals(trips: DataFrame, year: int, columns: TripColumns = TripColumns()) -> DataFrame:
    """One row: trips read, trips in ``year``, days of ``year`` with trips.

    Trips are counted per day first, so the distinct days cost no second pass
    and no shuffle of trips.
    """
    in_wanted = F.year("day") == year
    return (
        trips.groupBy(F.to_date(columns.pickup).alias("day"))
        .agg(F.count("*").alias("num_trips"))
        .agg(
            F.coalesce(F.sum("num_trips"), F.lit(0)).alias("trips_read"),
            F.coalesce(F.sum(F.when(in_wanted, F.col("num_trips"))), F.lit(0)).alias(
                "trips_in_year"
            ),
            F.count_if(in_wanted).alias("days_in_year"),
        )
    )
