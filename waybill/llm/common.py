"""What the operators share: table paths, staged intermediates and Arrow helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from waybill.session import scratch_path

#: Bytes of text that one step inside a task works on at a time (a single longer text makes a larger step).
STEP_BYTES = 4_000_000

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back.

    This cuts the lineage in a way that survives lost executors. Spark is asked
    to drop the shuffle files of that write once it has ended.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def discard(df: DataFrame) -> None:
    """Remove the files of a frame from ``staged`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 bounds of its values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, bounds, data = column.buffers()
    if not n or bounds is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(bounds, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def release_memory() -> None:
    """Give freed memory of Arrow and of the C heap back to the system, as Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # no glibc
        return


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in ``column`` each; every row is in one slice, whole.

    Freed memory is given back after the last slice.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = utf8(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    release_memory()


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A string column of UTF-8 bytes and bounds."""
    return pa.StringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def with_field(schema: StructType, name: str, kind: str) -> StructType:
    return StructType([*schema.fields, StructField(name, DataType.fromDDL(kind))])
