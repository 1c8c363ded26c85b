"""Settings of a stream's state that hold for the life of its checkpoint, and a look into that state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.streaming.clock import ROCKSDB

_PROVIDER, _PARTITIONS = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"


@contextmanager
def state_settings(spark: SparkSession, rocksdb: bool = False, partitions: int | None = None) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, or in so many partitions.

    Both are fixed in the checkpoint by the first start: choose the partitions by the
    number of open keys, not by the size of the input, since every batch commits them all. The
    session's own settings are back afterwards; a started query has a copy of them.
    """
    wanted = ({_PROVIDER: ROCKSDB} if rocksdb else {}) | ({_PARTITIONS: str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def open_windows(spark: SparkSession, checkpoint: str, key: str = "location") -> DataFrame:
    """What a stopped stream of windowed counts holds back: its windows that the watermark has not passed.

    Read from the checkpoint's last committed batch by Spark's state source, with either provider.
    """
    state = spark.read.format("statestore").option("path", checkpoint).load()
    return state.select(F.col(f"key.{key}").alias(key), F.col("key.window.start").alias("window_start"), F.col("value.count").alias("n"))
