"""Line sources and the parsed logs on top of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from waybill.operators import parsing


def lines_from_values(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    """Literal lines."""
    return spark.createDataFrame([(v,) for v in values], "value string")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line; the last line may lack its newline."""
    return spark.read.text(path)


def read_activity(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parsing.keep_valid(parsing.parse_activity(read_lines(spark, path)))


def read_legacy_activity(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parsing.keep_valid(parsing.parse_legacy_activity(read_lines(spark, path)))


def read_support_calls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parsing.keep_valid(parsing.parse_support_calls(read_lines(spark, path)))


def read_location_names(
    spark: SparkSession, path: str | list[str], full_name: bool = False
) -> DataFrame:
    return parsing.keep_valid(parsing.parse_location_names(read_lines(spark, path), full_name))
