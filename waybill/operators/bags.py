"""Two inputs grouped by key as raw rows in order, without a list per key.

Both sides become one tagged frame that is range-sorted by key and order. A busy key
runs on over several ranges; each range numbers its own rows of a key, and the counts of
the ranges before, one small row per key and range, are added as carried state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import scratch_path


def _tagged(df: DataFrame, side: int, key: str, order: list[Column], name: str, other: str, kind: str) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns])
    none = F.lit(None).cast(kind)
    return df.select(F.col(key), F.lit(side).alias("side"), *[o.alias(f"_{i}") for i, o in enumerate(order)], row.alias(name), none.alias(other))


def ordered_bags(
    left: DataFrame, right: DataFrame, key: str, order: dict[str, str], ties: list[str] | None = None, right_first: bool = True
) -> DataFrame:
    """Every row of both sides with its key, as ``left`` or ``right`` (the other is NULL), in order within the key.

    ``order`` names the column to order by on each side (keys "left" and "right", same
    type); at equal values the rows of ``right`` come first unless ``right_first`` is off;
    ``ties`` are columns of ``left`` that order its rows further. ``left_number`` and
    ``right_number`` count the key's rows of each side so far, the row itself included, so
    that a left row's ``right_number`` is what had come from the right by then. Rows that are
    equal in all of that are numbered in any order. A NULL key is a key like others.

    The ranges are cut between any two rows, equal ones too, so that neither a busy key
    nor a pile of copies fills a task. The ranged rows are written once to shared storage.
    """
    spark = left.sparkSession
    ties = ties or []
    kinds = {n: df.select(F.struct(*df.columns).alias("s")).schema["s"].dataType.simpleString() for n, df in (("left", left), ("right", right))}
    at = dict(left.dtypes)
    sides = {"left": int(right_first), "right": int(not right_first)}
    both = _tagged(left, sides["left"], key, [F.col(order["left"]), *map(F.col, ties)], "left", "right", kinds["right"]).unionByName(
        _tagged(right, sides["right"], key, [F.col(order["right"]), *[F.lit(None).cast(at[t]) for t in ties]], "right", "left", kinds["left"])
    )
    places = ["_0", "side", *[f"_{i + 1}" for i in range(len(ties))]]
    # The task and its row number tell equal rows apart, so that a pile of them can be cut.
    ranged = both.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(key, *places, "_copy")
    path = scratch_path(spark, "bags")
    ranged.withColumn("range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    is_left, is_right = ((F.col("side") == sides[n]).cast("bigint") for n in ("left", "right"))
    sizes = rows.groupBy(key, "range").agg(F.sum(is_left).alias("lefts"), F.sum(is_right).alias("rights"))
    before = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.select(
        F.col(key).alias("_key"), F.col("range").alias("_range"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("lefts", "rights")]
    )
    own = Window.partitionBy("range", key).orderBy(*places, "_copy").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumns({"_l": F.sum(is_left).over(own), "_r": F.sum(is_right).over(own)})
    joined = numbered.join(carried, (F.col("range") == F.col("_range")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(key, "left", "right", (F.col("_l") + F.col("_lefts")).alias("left_number"), (F.col("_r") + F.col("_rights")).alias("right_number"))


def activity_with_calls_so_far(activity: DataFrame, calls: DataFrame) -> DataFrame:
    """Each activity record with its number within the location, by time, and the calls the location had made by then.

    ``calls`` has ``location`` and ``call_epoch`` (seconds). A call in the second of the event counts.
    """
    timed = activity.withColumn("epoch", F.unix_seconds("event_time"))
    bags = ordered_bags(timed, calls, "location", {"left": "epoch", "right": "call_epoch"}, ["package_id", "truck_id", "is_arrival"])
    events = bags.where("left IS NOT NULL")
    return events.select(*[F.col(f"left.{c}").alias(c) for c in activity.columns], F.col("left_number").alias("number"), F.col("right_number").alias("calls_so_far"))
