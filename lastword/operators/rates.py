"""Windowed series: a 60 s reduction per series, then one across the series of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lastword.functions.instants import floor_div
from lastword.operators.quantiles import high_pick, interpolated, low_pick, order_statistics


def window_start(micros: Column, seconds: int = 60) -> Column:
    """Start of the aligned window, in seconds since 1970."""
    return floor_div(micros, seconds * 1_000_000) * seconds


def rate_sum(points: DataFrame, groups: list[str], seconds: int = 60) -> DataFrame:
    """Points per second, summed over all series of a group.

    The sum of per-series rates is the rate of their union, so one count per group is enough and
    the series never becomes a shuffle key.
    """
    return (points.groupBy("window_start", *groups)
            .agg((F.count(F.lit(1)) / F.lit(float(seconds))).alias("per_second")))


def mean_sum(points: DataFrame, series: str, groups: list[str]) -> DataFrame:
    """Mean per series and window, summed over the series of a group."""
    means = (points.groupBy("window_start", *groups, series)
             .agg(F.avg("value").alias("mean_value")))
    return means.groupBy("window_start", *groups).agg(F.sum("mean_value").alias("total"))


def percentile_max(points: DataFrame, q: float, series: str, groups: list[str]) -> DataFrame:
    """Interpolated percentile per series and window, the largest over the series of a group."""
    stats = order_statistics(points, "value", {"low": low_pick(q), "high": high_pick(q)},
                             ["window_start", *groups, series])
    each = stats.withColumn("p", interpolated(q, F.col("low"), F.col("high"), F.col("n")))
    return each.groupBy("window_start", *groups).agg(F.max("p").alias("worst"))


def volume(per_second: Column, bytes_per_record: Column) -> Column:
    """GiB per hour of a record rate."""
    return per_second * bytes_per_record * F.lit(3600) / F.lit(float(2**30))
