"""Keyed and global aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.records import vip_only
from waybill.schema import VIP_PREFIX


def count_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def vip_count_per_location(activity: DataFrame, prefix: str = VIP_PREFIX) -> DataFrame:
    """VIP *events* per location; a location without any has no row."""
    return count_per_key(vip_only(activity, prefix), "location")


def unique_vip_per_location(activity: DataFrame, prefix: str = VIP_PREFIX) -> DataFrame:
    """Distinct VIP *packages* per location; a location without any reports 0.

    Spark removes duplicates per (location, package) before it counts, so one
    busy location is spread over many tasks.
    """
    vip = F.when(F.startswith("package_id", F.lit(prefix)), F.col("package_id"))
    return activity.groupBy("location").agg(F.count_distinct(vip).alias("n"))


def mean_of(df: DataFrame, column: str) -> DataFrame:
    """The global mean as a one-row frame; NULL for no rows."""
    return df.agg(F.avg(column).alias("mean"))


def mean_vip_per_location(activity: DataFrame, prefix: str = VIP_PREFIX) -> DataFrame:
    return mean_of(vip_count_per_location(activity, prefix), "n")


def packages_per_truck(activity: DataFrame) -> DataFrame:
    """All package ids of every truck, one row per truck and id, with its copies.

    This is the whole grouped list in a form that never gathers a truck in one
    place: customers share one truck id, which may hold much of the log.
    """
    return activity.groupBy("truck_id", "package_id").agg(F.count(F.lit(1)).alias("copies"))


def packages_per_truck_text(activity: DataFrame) -> DataFrame:
    """``truck: id`` lines, one per entry and every copy kept, in order of truck and id.

    One line per entry instead of one line per truck, whatever the truck's size:
    customers share one truck id, and a line of half the log could not be
    written. A range sort keeps the order over the part files; its last key tells
    copies of one entry apart by their task, so that even a pile of them divides.
    """
    line = F.concat(F.col("truck_id"), F.lit(": "), F.col("package_id"))
    return (
        activity.select("truck_id", "package_id", line.alias("line"), F.spark_partition_id().alias("task"))
        .orderBy("truck_id", "package_id", "task")
        .select("line")
    )
