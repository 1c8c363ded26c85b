"""Small operations on files of any storage that Spark can write to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    files, where = _at(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one storage; fails if the target is there."""
    files, where = _at(spark, source)
    if exists(spark, target) or not files.rename(where, _at(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")
