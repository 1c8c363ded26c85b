"""Projections, filters and text forms of single records."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions import iso_utc
from waybill.schema import ACTIVITY_TEXT, VIP_PREFIX


def arrivals(activity: DataFrame) -> DataFrame:
    return activity.where("is_arrival")


def vip_only(activity: DataFrame, prefix: str = VIP_PREFIX) -> DataFrame:
    return activity.where(F.startswith("package_id", F.lit(prefix)))


def to_package_table(activity: DataFrame) -> DataFrame:
    """The columns of the package table (``schema.PACKAGE_TABLE``)."""
    return activity.select(
        F.col("package_id").alias("packageId"),
        "location",
        F.col("truck_id").alias("truckId"),
        F.col("event_time").alias("timestamp"),
    )


def activity_line() -> Column:
    """The text of a record; it names neither time nor truck."""
    start, location, package, end = (F.lit(part) for part in ACTIVITY_TEXT)
    return F.concat(
        start,
        F.col("is_arrival").cast("string"),
        location,
        F.col("location"),
        package,
        F.col("package_id"),
        end,
    )


def format_activity(activity: DataFrame) -> DataFrame:
    """One text line per record."""
    return activity.select(activity_line().alias("line"))


def records_and_rejects(parsed: DataFrame) -> DataFrame:
    """A line per parsed line: the record's text where it parsed, else the raw line, for ``write_routed`` by ``ok``."""
    return parsed.select("ok", F.when(F.col("ok"), activity_line()).otherwise(F.col("value")).alias("line"))


def format_counts(counts: DataFrame, key: str, count: str = "n") -> DataFrame:
    """``key: count`` lines."""
    return counts.select(F.concat(F.col(key).cast("string"), F.lit(": "), F.col(count)).alias("line"))


def format_hourly_counts(counts: DataFrame, tz: str = "UTC") -> DataFrame:
    """``Fri Jul 01 17:00:00 UTC 2016: 6`` lines: wall clock and zone name of ``tz``, the zone that was counted in."""
    shown = {"timestampFormat": "EEE MMM dd HH:mm:ss zzz yyyy", "timeZone": tz}
    hour = F.to_csv(F.struct("hour"), shown)
    return counts.select(F.concat(hour, F.lit(": "), F.col("n")).alias("line"))


def format_windowed_counts(counts: DataFrame, key: str = "location") -> DataFrame:
    """``AK: 3 2016-07-01T17:00:00.000Z`` lines: key, count, window start."""
    return counts.select(
        F.concat(
            F.col(key), F.lit(": "), F.col("n"), F.lit(" "), iso_utc(F.col("window_start"))
        ).alias("line")
    )


def par_do(
    df: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]],
    schema: T.StructType | str,
) -> DataFrame:
    """Escape hatch: any number of rows out per row in, by Python on Arrow batches.

    For what column expressions cannot say; nothing in this package needs it.
    """
    return df.mapInPandas(fn, schema)
