"""Appending that may be repeated, and metrics of each batch as files."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from waybill.sources.files import exists

BATCH = "batch_id"


def append_once(df: DataFrame, checkpoint: str, path: str, trigger: dict | None = None, output_mode: str = "append") -> StreamingQuery:
    """Append every batch to Parquet files at a path, a batch that is run again adding nothing.

    Each batch has its own folder, named by its number, with the marker that Spark leaves in it when
    all of it is written. A repeated batch finds the marker and is worked off without being written,
    for its state must be committed; one that broke off before is written anew. The checkpoint belongs to the path: do not start either without the other.
    """

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{path}/{BATCH}={number}"
        if exists(batch.sparkSession, f"{folder}/_SUCCESS"):
            batch.write.format("noop").mode("overwrite").save()
        else:
            batch.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)

    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()


def read_appended(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of all batches that ``append_once`` has written, without their numbers."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).drop(BATCH)


class MetricsLog(StreamingQueryListener):
    """Writes the counters of each batch of one query: a JSON file for every batch, repeated batches overwriting theirs.

    The line holds the query's id, the batch's number, rows read, rows that came too late for
    their window (after rows of one window and task are combined) and all observed metrics
    (``DataFrame.observe``) by name. Add it with ``spark.streams.addListener`` before the start.
    """

    def __init__(self, spark: SparkSession, path: str, query_name: str):
        self.spark, self.path, self.query_name = spark, path, query_name
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the metrics of all batches of a stopped query are written; listeners hear of them a little later."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no word of the end of {self.query_name}")

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        progress = event.progress
        if progress.name != self.query_name:
            return
        line = {
            "query": str(progress.id),
            "batch": progress.batchId,
            "rows": progress.numInputRows,
            "late": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
            "observed": {name: row.asDict() for name, row in progress.observedMetrics.items()},
        }
        frame = self.spark.createDataFrame([(json.dumps(line),)], "value string").coalesce(1)
        frame.write.mode("overwrite").text(f"{self.path}/query={progress.id}/batch={progress.batchId}")


def read_metrics(spark: SparkSession, path: str, observed: str) -> DataFrame:
    """The lines of ``MetricsLog``; ``observed`` is the type of the observed metrics, such as ``lines struct<invalid: bigint>``."""
    kind = f"query string, batch bigint, rows bigint, late bigint, observed struct<{observed}>"
    return spark.read.text(path).select(F.from_json("value", kind).alias("m")).select("m.*")
