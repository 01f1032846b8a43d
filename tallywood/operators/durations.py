"""Application durations and the numbers behind their charts.

Durations are whole seconds, so a cluster's applications first shrink to
counts per second.  Each step after that works on those counts, however many
applications one cluster has.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions.text import whole_seconds
from tallywood.operators.usage import cluster_summary


def in_top_cluster(timeline: DataFrame) -> DataFrame:
    """Timeline rows of the cluster with most applications."""
    # One row by construction, so it may be broadcast whatever the input.
    top = cluster_summary(timeline).limit(1).select("cluster_id")
    return timeline.join(F.broadcast(top), "cluster_id", "left_semi")


def app_durations(timeline: DataFrame) -> DataFrame:
    """``application_id, cluster_id, duration_sec, n`` with ``n`` per cluster."""
    sizes = timeline.groupBy("cluster_id").agg(F.count("app_start").alias("n"))
    return (
        timeline.withColumn("duration_sec", whole_seconds(F.col("app_start"), F.col("app_end")))
        .join(sizes, "cluster_id")
        .select("application_id", "cluster_id", "duration_sec", "n")
    )


def _seconds(timeline: DataFrame) -> DataFrame:
    return timeline.select(
        "cluster_id", whole_seconds(F.col("app_start"), F.col("app_end")).alias("duration_sec")
    )


def _distribution(timeline: DataFrame) -> DataFrame:
    return (
        _seconds(timeline)
        .groupBy("cluster_id", "duration_sec")
        .agg(F.count("*").alias("num_applications"))
    )


def duration_histogram(timeline: DataFrame, bins: int = 50) -> DataFrame:
    """Applications per equal-width duration bin, for each cluster given.

    Bins run from a cluster's shortest to its longest duration and the last
    one is closed.  Bins without applications have no row.
    """
    counts = _distribution(timeline)
    bounds = counts.groupBy("cluster_id").agg(
        F.min("duration_sec").alias("low"),
        F.max("duration_sec").alias("high"),
    )
    low, high = F.col("low"), F.col("high")
    place = F.when(
        high > low,
        F.least(
            F.floor((F.col("duration_sec") - low) * bins / (high - low)), F.lit(bins - 1)
        ),
    ).otherwise(F.lit(0))
    width = (high - low) / bins
    return (
        counts.join(bounds, "cluster_id")
        .select("cluster_id", place.cast("int").alias("bin"), "low", "high", "num_applications")
        .groupBy("cluster_id", "bin", "low", "high")
        .agg(F.sum("num_applications").alias("num_applications"))
        .select(
            "cluster_id",
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            "num_applications",
        )
    )


def duration_density(timeline: DataFrame, points: int = 200) -> DataFrame:
    """Gaussian kernel density of the durations of each cluster given.

    Evaluated at ``points`` even steps from shortest to longest duration with
    bandwidth ``n ** -0.2 * stddev``.  Every distinct duration adds to a fixed
    number of points and is summed in its own task before the shuffle.
    Clusters whose durations do not vary have no density and no rows.
    """
    counts = _distribution(timeline)
    shape = (
        _seconds(timeline)
        .groupBy("cluster_id")
        .agg(
            F.count("*").alias("n"),
            F.min("duration_sec").alias("low"),
            F.max("duration_sec").alias("high"),
            F.stddev_samp("duration_sec").alias("spread"),
        )
        .where(F.col("spread") > 0)
        .select(
            "cluster_id",
            "n",
            "low",
            ((F.col("high") - F.col("low")) / (points - 1)).alias("step"),
            (F.pow(F.col("n"), F.lit(-0.2)) * F.col("spread")).alias("bandwidth"),
        )
    )
    at = F.col("low") + F.col("point") * F.col("step")
    distance = (at - F.col("duration_sec")) / F.col("bandwidth")
    weight = F.col("num_applications") * F.exp(distance * distance * -0.5)
    return (
        counts.join(shape, "cluster_id")
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("cluster_id", "point", "n", "low", "step", "bandwidth")
        .agg(F.sum(weight).alias("weight"))
        .select(
            "cluster_id",
            "point",
            at.alias("duration_sec"),
            F.round(
                F.col("weight") / (F.col("n") * F.col("bandwidth") * math.sqrt(2 * math.pi)), 12
            ).alias("density"),
        )
    )
