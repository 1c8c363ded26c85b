"""Activity combined with support calls and location names, and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.aggregates import count_per_key
from waybill.schema import (
    REPORT_ARRIVED,
    REPORT_CALLS,
    REPORT_DEPARTED,
    REPORT_END,
    REPORT_FOOTER_STARS,
    REPORT_HEADER_STARS,
    REPORT_LOCATION,
)


def with_location_name(df: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``name`` by location; NULL where the map has none.

    A code that occurs twice in the map fails the job instead of multiplying
    rows. There is no broadcast hint: Spark broadcasts the map when its size
    is below the threshold and otherwise shuffles and splits hot locations.
    """
    unique = names.groupBy("location").agg(
        F.when(F.count(F.lit(1)) == 1, F.min("name"))
        .otherwise(F.raise_error(F.concat(F.lit("duplicate location code: "), F.col("location"))))
        .alias("name")
    )
    return df.join(unique, "location", "left")


def location_activity_with_calls(
    activity: DataFrame, calls: DataFrame, names: DataFrame | None = None
) -> DataFrame:
    """Activity and call totals of every location that occurs in either input.

    Both sides are reduced to one row per location before they meet, so the
    join moves no raw rows and cannot be skewed.
    """
    totals = activity.groupBy("location").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_arrival").alias("arrivals")
    )
    called = count_per_key(calls, "location").withColumnRenamed("n", "calls")
    joined = totals.join(called, "location", "full_outer").select(
        "location",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("events", "arrivals", "calls")],
    )
    return with_location_name(joined, names) if names is not None else joined


def location_report_lines(
    activity: DataFrame, calls: DataFrame, names: DataFrame
) -> DataFrame:
    """The report of every location, one row per line.

    ``section`` orders the parts: 0 header, 1 name, 2 calls, 3 events, 4 footer.
    Event lines come straight from the activity rows, without a shuffle.
    """
    location = F.col("location")
    frame = [
        (0, F.concat(location, F.repeat(F.lit("*"), F.lit(REPORT_HEADER_STARS)))),
        (1, F.concat(F.lit(REPORT_LOCATION), F.coalesce("name", F.lit("null")))),
        (2, F.concat(F.lit(REPORT_CALLS), F.col("calls"))),
        (4, F.concat(F.lit(REPORT_END), location, F.repeat(F.lit("*"), F.lit(REPORT_FOOTER_STARS)))),
    ]
    rows = F.array(*[F.struct(F.lit(s).alias("section"), text.alias("line")) for s, text in frame])
    frames = location_activity_with_calls(activity, calls, names).select(
        "location",
        F.inline(rows),
        F.lit(None).cast("timestamp").alias("event_time"),
        F.lit(None).cast("string").alias("package_id"),
    )
    label = F.when(F.col("is_arrival"), F.lit(REPORT_ARRIVED)).otherwise(F.lit(REPORT_DEPARTED))
    events = activity.select(
        "location",
        F.lit(3).alias("section"),
        F.concat(label, F.col("package_id")).alias("line"),
        "event_time",
        "package_id",
    )
    return frames.unionByName(events)


def location_report_text(report: DataFrame) -> DataFrame:
    """The report lines in reading order, ready for ``write_lines``.

    A range sort, not a list per location: a busy location simply runs on over
    several part files. The last sort key tells copies of one event apart by
    the task they come from, so that even a pile of them can be divided.
    """
    return (
        report.withColumn("task", F.spark_partition_id())
        .orderBy("location", "section", "event_time", "package_id", "line", "task")
        .select("line")
    )
