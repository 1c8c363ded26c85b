"""Text, record and table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.sources.files import exists, move, remove

# How the two write dispositions map to Spark's save modes; both create the
# table if it is missing.
TABLE_MODES = {"truncate": "overwrite", "append": "append"}


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    """A frame with one string column to a folder of text files."""
    lines.write.mode(mode).options(**options).text(path)


def write_records(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", **options: str
) -> None:
    """Records to files with their schema.

    ``fmt`` is any Spark format. Avro needs the spark-avro package on the
    classpath; without it Spark says so and nothing is written.
    """
    df.write.format(fmt).mode(mode).options(**options).save(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_table(
    df: DataFrame,
    schema: T.StructType,
    disposition: str,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Write to a catalog table, or to table files at a path, with a declared schema.

    ``disposition`` is "truncate" (replace the content) or "append". Replacing
    writes the new content in full before it touches the old, see
    ``replace_table`` and ``replace_files``: a job that fails leaves the table whole.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table name or a path")
    if disposition not in TABLE_MODES:
        raise ValueError(f"no such disposition: {disposition}")
    rows = conform(df, schema)
    if disposition == "append":
        writer = rows.write.format(fmt).mode(TABLE_MODES[disposition])
        writer.saveAsTable(table) if table is not None else writer.save(path)
    elif table is not None:
        replace_table(rows, table, fmt=fmt)
    else:
        replace_files(rows, path, fmt)


def replace_table(df: DataFrame, table: str, root: str | None = None, fmt: str = "parquet") -> str | None:
    """Put new content behind a catalog table; returns the folder of the old content, or None.

    The content goes to a folder of its own below ``root`` (default: beside the table in the
    warehouse), then the table's location is changed, a single step in the catalog. Readers that have
    planned go on with the old files, which stay until the caller removes them (``files.remove``).
    """
    spark = df.sparkSession
    there = spark.catalog.tableExists(table)
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()} if there else {}
    old = details.get("Location")
    root = root or (spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/" + table.replace(".", "/").replace("`", "") + "-versions")
    new = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.format(fmt).save(new)
    if there:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    else:
        spark.catalog.createTable(table, path=new, source=fmt, schema=df.schema)
    spark.catalog.refreshTable(table)
    return old


def replace_files(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Put new content at a path: written beside it, then moved in when it is complete.

    Between the two moves the path is empty for a moment; readers that must not see
    that read through a catalog table (``replace_table``).
    """
    spark, unique = df.sparkSession, uuid.uuid4().hex
    fresh, old = (f"{path.rstrip('/')}.{kind}-{unique}" for kind in ("new", "old"))
    try:
        df.write.format(fmt).save(fresh)
    except Exception:
        remove(spark, fresh)
        raise
    if exists(spark, path):
        move(spark, path, old)
    move(spark, fresh, path)
    remove(spark, old)


def write_routed(
    df: DataFrame, route: str, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Every value of ``route`` to its own folder, in a single pass over the input."""
    df.write.partitionBy(route).format(fmt).mode(mode).save(path)


def write_many(
    shared: DataFrame,
    *writers: Callable[[DataFrame], object],
    storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> None:
    """Several outputs that start from one frame, which is computed once.

    Meant for reduced frames such as counts. For routing raw rows to sinks
    ``write_routed`` needs no storage at all.
    """
    shared.persist(storage)
    try:
        for write in writers:
            write(shared)
    finally:
        shared.unpersist()
