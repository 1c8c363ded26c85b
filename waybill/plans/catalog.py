"""The queries by name: each takes (session, table folder) and gives a frame.

Times leave as epoch seconds, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill import sources, streaming
from waybill.functions import time_to_millis
from waybill.operators import (
    aggregates,
    bags,
    combine,
    locations,
    parsing,
    records,
    windows,
)
from waybill.plans import eventlog
from waybill.plans.eventlog import EventLog
from waybill.schema import COUNT_TABLE, PACKAGE_TABLE
from waybill.session import scratch_path
from waybill.sources import files

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[EventLog], DataFrame]) -> Callable[[EventLog], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, folder: build(EventLog(spark, folder))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _in_seconds(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(column, F.unix_seconds(column)).withColumnRenamed(column, name)


def _records(activity: DataFrame) -> DataFrame:
    return _in_seconds(activity, "event_time", "event_epoch")


# Parsing, rejects, projections


@_query
def parse_activity(log: EventLog) -> DataFrame:
    return _records(log.activity)


@_query
def parse_legacy_activity(log: EventLog) -> DataFrame:
    return _records(log.legacy)


@_query
def rejected_lines(log: EventLog) -> DataFrame:
    _, rejects = parsing.split_valid_rejects(log.parsed)
    return rejects


@_query
def rejected_other_lines(log: EventLog) -> DataFrame:
    """Rejects of the old log, the calls and the names, with the log they are from."""
    events = log.table("events")
    parsed = {
        "legacy": parsing.parse_legacy_activity(eventlog.legacy_lines(events)),
        "calls": parsing.parse_support_calls(eventlog.call_lines(events)),
        "names": parsing.parse_location_names(eventlog.name_lines(log.table("nation"))),
    }
    rejects = [parsing.keep_rejects(frame).withColumn("log", F.lit(name)) for name, frame in parsed.items()]
    return rejects[0].unionByName(rejects[1]).unionByName(rejects[2])


@_query
def invalid_line_count(log: EventLog) -> DataFrame:
    return parsing.count_invalid(log.parsed)


@_query
def invalid_line_metric(log: EventLog) -> DataFrame:
    """The counter that one write fills, next to the rows it wrote."""
    path = scratch_path(log.spark, "counted")
    parsed, counter = parsing.with_invalid_counter(log.parsed)
    sources.write_records(parsing.keep_valid(parsed), path)
    written = log.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("written"))
    return written.select(F.lit(counter.get["invalid_lines"]).cast("bigint").alias("invalid"), "written")


@_query
def parse_support_calls(log: EventLog) -> DataFrame:
    return log.calls


@_query
def parse_location_names(log: EventLog) -> DataFrame:
    return log.names


@_query
def arrivals_table(log: EventLog) -> DataFrame:
    table = records.to_package_table(records.arrivals(log.activity))
    return _in_seconds(table, "timestamp", "event_epoch")


@_query
def vip_activity(log: EventLog) -> DataFrame:
    return _records(records.vip_only(log.activity))


@_query
def activity_text(log: EventLog) -> DataFrame:
    return records.format_activity(log.activity)


@_query
def activity_epoch_millis(log: EventLog) -> DataFrame:
    return log.activity.select("location", "package_id", time_to_millis(F.col("event_time")).alias("event_millis"))


@_query
def par_do_tags(log: EventLog) -> DataFrame:
    """The Python escape hatch on a small example; ``where`` and ``union`` would do the same."""

    def tags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vip = batch.package_id.str.startswith("VIP")
            for tag, rows in (("arrival", batch[batch.is_arrival]), ("vip", batch[vip])):
                yield rows[["package_id"]].assign(tag=tag)

    picked = parsing.keep_valid(log.parsed, "is_arrival", "package_id")
    return records.par_do(picked, tags, "package_id string, tag string")


# Aggregates


@_query
def count_per_location(log: EventLog) -> DataFrame:
    return aggregates.count_per_key(log.activity, "location")


@_query
def count_text(log: EventLog) -> DataFrame:
    return records.format_counts(aggregates.count_per_key(log.activity, "location"), "location")


@_query
def unique_vip_per_location(log: EventLog) -> DataFrame:
    return aggregates.unique_vip_per_location(log.activity)


@_query
def vip_count_per_location(log: EventLog) -> DataFrame:
    return aggregates.vip_count_per_location(log.activity)


@_query
def mean_vip_per_location(log: EventLog) -> DataFrame:
    return aggregates.mean_vip_per_location(log.activity)


@_query
def packages_per_truck(log: EventLog) -> DataFrame:
    return aggregates.packages_per_truck(log.activity)


@_query
def packages_per_truck_text(log: EventLog) -> DataFrame:
    return aggregates.packages_per_truck_text(parsing.keep_valid(log.parsed, "truck_id", "package_id"))


@_query
def support_calls_per_location(log: EventLog) -> DataFrame:
    return aggregates.count_per_key(log.calls, "location")


# Union and partition


@_query
def union_with_legacy(log: EventLog) -> DataFrame:
    return _records(combine.union_activity(log.activity, log.legacy))


@_query
def partition_old_new(log: EventLog) -> DataFrame:
    both = combine.union_activity(log.activity, log.legacy)
    return _records(combine.old_new_trucks(both))


@_query
def partitions_from_one_pass(log: EventLog) -> DataFrame:
    """Four parts by truck, taken apart and each marked with its number; the logs are parsed once."""
    both = combine.union_activity(log.activity, log.legacy)
    parts = combine.staged_partitions(combine.partition_activity(both, 4, F.pmod("truck_id", F.lit(16)).cast("int") / 4), 4)
    marked = [part.withColumn("part", F.lit(i)) for i, part in enumerate(parts)]
    return _records(combine.union_activity(*marked))


# Windows


@_query
def hourly_counts(log: EventLog) -> DataFrame:
    return _in_seconds(windows.hourly_counts(log.activity, "UTC"), "hour", "hour_epoch")


@_query
def hourly_counts_half_hour_zone(log: EventLog) -> DataFrame:
    return _in_seconds(windows.hourly_counts(log.activity, "Asia/Kolkata"), "hour", "hour_epoch")


@_query
def hourly_count_text(log: EventLog) -> DataFrame:
    return records.format_hourly_counts(windows.hourly_counts(log.activity, "UTC"), "UTC")


@_query
def hourly_count_text_half_hour_zone(log: EventLog) -> DataFrame:
    zone = "Asia/Kolkata"
    return records.format_hourly_counts(windows.hourly_counts(log.activity, zone), zone)


@_query
def windowed_counts_60m(log: EventLog) -> DataFrame:
    return _in_seconds(windows.windowed_counts(log.activity), "window_start", "window_epoch")


@_query
def windowed_counts_1m(log: EventLog) -> DataFrame:
    counts = windows.windowed_counts(log.activity, "1 minute")
    return _in_seconds(counts, "window_start", "window_epoch")


@_query
def windowed_count_text(log: EventLog) -> DataFrame:
    return records.format_windowed_counts(windows.windowed_counts(log.activity))


# Joins and the report


@_query
def activity_with_location_name(log: EventLog) -> DataFrame:
    return _records(locations.with_location_name(log.activity, log.names))


@_query
def location_activity_with_calls(log: EventLog) -> DataFrame:
    return locations.location_activity_with_calls(log.activity, log.calls, log.names)


@_query
def activity_numbered_with_calls(log: EventLog) -> DataFrame:
    """The raw bags of both inputs by location: each record's number, and the calls there had been by then."""
    return _records(bags.activity_with_calls_so_far(log.activity, log.calls))


@_query
def location_report_lines(log: EventLog) -> DataFrame:
    report = locations.location_report_lines(log.activity, log.calls, log.names)
    return report.select("location", "section", "line")


@_query
def location_report_text(log: EventLog) -> DataFrame:
    """The log is parsed once: the report's totals, its event lines and the sort's sample read the staged records."""
    path = scratch_path(log.spark, "report-records")
    sources.write_records(parsing.keep_valid(log.parsed, "location", "is_arrival", "event_time", "package_id"), path)
    report = locations.location_report_lines(log.spark.read.parquet(path), log.calls, log.names)
    return locations.location_report_text(report)


# Files and tables: written, then read back


@_query
def text_log_files(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "activity-log")
    sources.write_lines(log.lines, path)
    return _records(sources.read_activity(log.spark, path))


@_query
def legacy_log_files(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "legacy-log")
    sources.write_lines(eventlog.legacy_lines(log.table("events")), path)
    return _records(sources.read_legacy_activity(log.spark, path))


@_query
def location_files(log: EventLog) -> DataFrame:
    calls, names = scratch_path(log.spark, "calls"), scratch_path(log.spark, "names")
    sources.write_lines(eventlog.call_lines(log.table("events")), calls)
    sources.write_lines(eventlog.name_lines(log.table("nation")), names)
    return locations.with_location_name(
        aggregates.count_per_key(sources.read_support_calls(log.spark, calls), "location"),
        sources.read_location_names(log.spark, names, full_name=True),
    )


@_query
def activity_text_files(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "activity-text")
    sources.write_lines(records.format_activity(log.activity), path)
    return sources.read_lines(log.spark, path).select(F.col("value").alias("line"))


@_query
def record_files(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "records")
    sources.write_records(log.activity, path)
    return _records(log.spark.read.parquet(path))


@_query
def package_table_truncate(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "package-table")
    table = records.to_package_table(records.arrivals(log.activity))
    for _ in range(2):
        sources.write_table(table, PACKAGE_TABLE, "truncate", path=path)
    return _in_seconds(log.spark.read.parquet(path), "timestamp", "event_epoch")


@_query
def package_table_replaced(log: EventLog) -> DataFrame:
    """A catalog table whose content is replaced; a third write that breaks off leaves it as it was."""
    spark, name = log.spark, f"package_table_{uuid.uuid4().hex}"
    table = records.to_package_table(log.activity)
    arrived = records.to_package_table(records.arrivals(log.activity))
    failing = F.when(F.col("truckId") < 0, F.col("location")).otherwise(F.raise_error(F.lit("broken off")).cast("string"))
    root = scratch_path(spark, "package-table-versions")
    for content in (table, arrived):
        sources.replace_table(content, name, root)
    try:
        sources.replace_table(arrived.withColumn("location", failing), name, root)
    except PySparkException as broken:
        if "broken off" not in str(broken):
            raise
    back = _in_seconds(spark.table(name), "timestamp", "event_epoch")
    # The rows are known by their files from here on; the name is not needed any more.
    back.schema  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return back


@_query
def count_table_append(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "count-table")
    for width in ("60 minutes", "1 minute"):
        counts = windows.to_count_table(windows.windowed_counts(log.activity, width))
        sources.write_table(counts, COUNT_TABLE, "append", path=path)
    return _in_seconds(log.spark.read.parquet(path), "timestamp", "window_epoch")


@_query
def routed_lines(log: EventLog) -> DataFrame:
    path = scratch_path(log.spark, "routed")
    sources.write_routed(log.parsed.select("ok", "value"), "ok", path)
    return log.spark.read.parquet(path).select(F.col("ok").cast("string").alias("ok"), "value")


@_query
def records_and_rejects_text(log: EventLog) -> DataFrame:
    """Formatted records and raw rejects to two folders of text in a single pass."""
    path = scratch_path(log.spark, "records-and-rejects")
    sources.write_routed(records.records_and_rejects(log.parsed), "ok", path, "text")
    return log.spark.read.text(path).select(F.col("ok").cast("string").alias("ok"), F.col("value").alias("line"))


@_query
def old_new_text(log: EventLog) -> DataFrame:
    """Formatted records of old and new trucks to two folders of text in a single pass."""
    path = scratch_path(log.spark, "old-new")
    parts = combine.old_new_trucks(combine.union_activity(log.activity, log.legacy))
    sources.write_routed(parts.select("part", records.activity_line().alias("line")), "part", path, "text")
    return log.spark.read.text(path).select("part", F.col("value").alias("line"))


@_query
def several_sinks(log: EventLog) -> DataFrame:
    lines, mean = scratch_path(log.spark, "vip-lines"), scratch_path(log.spark, "vip-mean")
    sources.write_many(
        aggregates.vip_count_per_location(log.activity),
        lambda counts: sources.write_lines(records.format_counts(counts, "location"), lines),
        lambda counts: sources.write_records(aggregates.mean_of(counts, "n"), mean),
    )
    means = log.spark.read.parquet(mean).select(F.lit("mean").alias("line"), "mean")
    counts = sources.read_lines(log.spark, lines).select(
        F.col("value").alias("line"), F.lit(None).cast("double").alias("mean")
    )
    return counts.union(means)


# Streams


def _streamed(log: EventLog) -> DataFrame:
    activity = parsing.keep_valid(parsing.parse_activity(log.streamed_lines))
    return streaming.stream_windowed_counts(activity)


@_query
def stream_counts_1m_append(log: EventLog) -> DataFrame:
    out = scratch_path(log.spark, "stream-append")
    streaming.stream_to_table(_streamed(log), f"{out}-checkpoint", path=out).awaitTermination()
    return _in_seconds(log.spark.read.parquet(out), "window_start", "window_epoch")


@_query
def stream_counts_resumed(log: EventLog) -> DataFrame:
    """Log files arrive in three lots by time; the stream is restarted for each."""
    incoming, out = scratch_path(log.spark, "stream-incoming"), scratch_path(log.spark, "stream-resumed")
    for lot in _by_thirds(log):
        sources.write_lines(eventlog.activity_lines(lot), incoming, mode="append")
        counts = streaming.stream_windowed_counts(streaming.stream_activity(log.spark, incoming))
        # Few windows are open at a time: two partitions of state, for good.
        with streaming.state_settings(log.spark, partitions=2):
            query = streaming.stream_to_table(counts, f"{out}-checkpoint", path=out)
        query.awaitTermination()
    return _in_seconds(log.spark.read.parquet(out), "window_start", "window_epoch")


@_query
def stream_counts_late(log: EventLog) -> DataFrame:
    """A tenth of the first half of the log arrives with the second half, too late for its windows."""
    incoming = scratch_path(log.spark, "stream-late-incoming")
    out = scratch_path(log.spark, "stream-late")
    events = log.table("events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    half = F.lit(first + (last - first) / 2).cast(events.schema["ts"].dataType)
    in_time = F.coalesce((F.col("ts") < half) & (F.col("event_id") % 10 != 0), F.lit(False))
    for lot in (in_time, ~in_time):
        sources.write_lines(eventlog.activity_lines(events.where(lot)), incoming, mode="append")
        counts = streaming.stream_windowed_counts(streaming.stream_activity(log.spark, incoming))
        streaming.stream_to_table(counts, f"{out}-checkpoint", path=out).awaitTermination()
    return _in_seconds(log.spark.read.parquet(out), "window_start", "window_epoch")


def _by_thirds(log: EventLog) -> list[DataFrame]:
    """The events in three lots by time."""
    events = log.table("events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    edges = [F.lit(first + (last - first) * i / 3).cast(events.schema["ts"].dataType) for i in (1, 2)]
    ts = F.col("ts")
    return [events.where(lot) for lot in (ts < edges[0], ts.between(*edges), ts > edges[1])]


@_query
def stream_counts_by_clock(log: EventLog) -> DataFrame:
    """All windows, the last ones too: the stream goes idle and the clock closes them."""
    out, delay = scratch_path(log.spark, "stream-clock"), 2
    counts = streaming.stream_counts_by_clock(parsing.keep_valid(parsing.parse_activity(log.streamed_lines)), 60, delay_seconds=delay)
    with streaming.state_settings(log.spark, rocksdb=True, partitions=log.spark.sparkContext.defaultParallelism):
        query = streaming.stream_to_table(counts, f"{out}-checkpoint", path=out, trigger={"processingTime": "1 second"})
    streaming.stop_when_idle(query, delay)
    return _in_seconds(log.spark.read.parquet(out), "window_start", "window_epoch")


@_query
def stream_open_windows(log: EventLog) -> DataFrame:
    """What a stopped stream still holds back, read from its state."""
    out = scratch_path(log.spark, "stream-open")
    with streaming.state_settings(log.spark, rocksdb=True, partitions=2):
        query = streaming.stream_to_table(_streamed(log), f"{out}-checkpoint", path=out)
    query.awaitTermination()
    return _in_seconds(streaming.open_windows(log.spark, f"{out}-checkpoint"), "window_start", "window_epoch")


@_query
def stream_counts_replayed(log: EventLog) -> DataFrame:
    """The last batch of each of three lots is run twice, as after a failure before its commit."""
    incoming, out = scratch_path(log.spark, "stream-replay-incoming"), scratch_path(log.spark, "stream-replay")
    for lot in _by_thirds(log):
        sources.write_lines(eventlog.activity_lines(lot), incoming, mode="append")
        for _ in range(2):
            counts = streaming.stream_windowed_counts(streaming.stream_activity(log.spark, incoming))
            with streaming.state_settings(log.spark, partitions=2):
                query = streaming.append_once(counts, f"{out}-checkpoint", out)
            query.awaitTermination()
            last = query.lastProgress
            if last:
                files.remove(log.spark, f"{out}-checkpoint/commits/{last['batchId']}")
    return _in_seconds(streaming.read_appended(log.spark, out), "window_start", "window_epoch")


@_query
def stream_metrics(log: EventLog) -> DataFrame:
    """Lines, invalid lines and whether any came too late, per batch with input of the stream of ``stream_counts_late``."""
    spark, events = log.spark, log.table("events")
    incoming, out = scratch_path(spark, "stream-metrics-incoming"), scratch_path(spark, "stream-metrics")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    half = F.lit(first + (last - first) / 2).cast(events.schema["ts"].dataType)
    in_time = F.coalesce((F.col("ts") < half) & (F.col("event_id") % 10 != 0), F.lit(False))
    name = f"metrics-{uuid.uuid4().hex}"
    metrics = streaming.MetricsLog(spark, f"{out}-log", name)
    spark.streams.addListener(metrics)
    try:
        for lot in (in_time, ~in_time):
            sources.write_lines(eventlog.activity_lines(events.where(lot)), incoming, mode="append")
            parsed = parsing.parse_activity(streaming.stream_lines(spark, incoming))
            counted = parsed.observe("lines", F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("ok")).alias("invalid"))
            counts = streaming.stream_windowed_counts(parsing.keep_valid(counted))
            with streaming.state_settings(spark, partitions=2):
                query = streaming.stream_to_table(counts, f"{out}-checkpoint", path=out, name=name)
            query.awaitTermination()
            metrics.wait(query)
    finally:
        spark.streams.removeListener(metrics)
    found = streaming.read_metrics(spark, f"{out}-log", "lines: struct<lines: bigint, invalid: bigint>").where("rows > 0")
    lot = F.row_number().over(Window.partitionBy("query").orderBy("batch"))
    return found.select(lot.alias("lot"), "observed.lines.lines", "observed.lines.invalid", (F.col("late") > 0).alias("late"))
