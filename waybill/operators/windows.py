"""Counts per event-time window; the same functions serve batch and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import hour_start
from waybill.operators.aggregates import count_per_key


def windowed_counts(
    activity: DataFrame, width: str = "60 minutes", key: str = "location"
) -> DataFrame:
    """Rows per key and tumbling window; windows start at multiples of the width in UTC."""
    return (
        activity.groupBy(F.window("event_time", width), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("window.start").alias("window_start"), "n")
    )


def hourly_counts(activity: DataFrame, tz: str | None = None) -> DataFrame:
    """Rows per wall-clock hour of ``tz`` (default: the session's zone), no other key.

    In zones off by half an hour these hours are not the windows above.
    """
    return count_per_key(activity.select(hour_start(F.col("event_time"), tz).alias("hour")), "hour")


def to_count_table(counts: DataFrame) -> DataFrame:
    """The columns of the count table (``schema.COUNT_TABLE``)."""
    return counts.select(
        "location", F.col("n").alias("count"), F.col("window_start").alias("timestamp")
    )
