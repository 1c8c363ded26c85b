"""Union of activity frames and splitting by a partition number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.schema import NEW_TRUCK_THRESHOLD
from waybill.session import scratch_path
from waybill.sources.writers import write_routed


def union_activity(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def partition_activity(df: DataFrame, n: int, part: Column) -> DataFrame:
    """Add ``part``, which must lie in [0, n); anything else fails the job.

    Write all parts in one pass with ``write_routed(df, "part", path)``, or take
    them apart with ``split_partitions``.
    """
    shown = F.coalesce(part.cast("string"), F.lit("null"))
    failure = F.raise_error(F.concat(F.lit(f"partition not in [0, {n}): "), shown))
    checked = F.when(part.between(0, n - 1), part).otherwise(failure.cast("int"))
    return df.withColumn("part", checked.cast("int"))


def old_new_trucks(activity: DataFrame, threshold: int = NEW_TRUCK_THRESHOLD) -> DataFrame:
    """Part 0 holds trucks below the threshold (old), part 1 the rest (new)."""
    return partition_activity(activity, 2, F.when(F.col("truck_id") < threshold, 0).otherwise(1))


def split_partitions(parted: DataFrame, n: int) -> list[DataFrame]:
    """The n disjoint frames of a parted frame, each of which works the input off again; see ``staged_partitions``."""
    return [parted.where(F.col("part") == i).drop("part") for i in range(n)]


def staged_partitions(parted: DataFrame, n: int, path: str | None = None) -> list[DataFrame]:
    """The n disjoint frames of a parted frame, from a single pass over its input.

    All parts are written once, each to its own folder below ``path`` (default: in the shared
    scratch folder); every frame reads its own folder only. A part without rows is an empty frame.
    """
    spark = parted.sparkSession
    path = path or scratch_path(spark, "parts")
    write_routed(parted, "part", path)
    rows = spark.read.schema(parted.schema).parquet(path)
    return [rows.where(F.col("part") == i).drop("part") for i in range(n)]
