"""The activity log as a stream: source, windowed counts and sinks.

Progress, window state and the list of finished output files live in the
checkpoint folder: a restarted query goes on where it stopped and writes no row
twice. Put that folder, like the output, on storage all executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from waybill.operators.parsing import keep_valid, parse_activity
from waybill.operators.windows import windowed_counts


def stream_lines(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, bytes_per_batch: str | None = None
) -> DataFrame:
    """Lines of the text files that arrive in a folder.

    Files are taken in order of modification time. With several batches they
    should arrive in event-time order, or rows may come too late for their
    window; without a limit each batch takes all files there are. A backlog of
    any size should have one: ``files_per_batch`` or ``bytes_per_batch`` (such as
    "10g"). Which rows are late depends on it. Window state is kept on the
    executors' heaps by default; for many keys set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.text(folder)


def stream_activity(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    return keep_valid(parse_activity(stream_lines(spark, folder, files_per_batch)))


def stream_windowed_counts(
    activity: DataFrame, width: str = "1 minute", key: str = "location", delay: str = "5 seconds"
) -> DataFrame:
    """Counts per key and window, final once the watermark has passed the window.

    The watermark is the latest event time seen less ``delay`` (not the clock's
    time). Rows of closed windows are dropped and counted in the query's
    ``numRowsDroppedByWatermark``.
    """
    return windowed_counts(activity.withWatermark("event_time", delay), width, key)


def stream_to_table(
    df: DataFrame,
    checkpoint: str,
    table: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append finished rows to a table, or to Parquet files at a path; ``name`` is the query's name for listeners.

    The default trigger works off what is there and stops; pass for instance
    ``{"processingTime": "1 minute"}`` to keep running.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table name or a path")
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if name is not None:
        writer = writer.queryName(name)
    return writer.toTable(table) if table is not None else writer.start(path)
