from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests import samples
from waybill import sources
from waybill.operators import aggregates, combine, parsing, records, windows
from waybill.schema import COUNT_TABLE, PACKAGE_TABLE
from waybill.session import scratch_path


@pytest.fixture(scope="module")
def parsed(spark):
    return parsing.parse_activity(sources.lines_from_values(spark, samples.ACTIVITY_LOG))


@pytest.fixture(scope="module")
def activity(parsed):
    return parsing.keep_valid(parsed)


def read(spark, path):
    return sorted(r.value for r in sources.read_lines(spark, path).collect())


def test_lines(spark, activity, tmp_path):
    path = str(tmp_path / "lines")
    lines = records.format_activity(activity)
    sources.write_lines(lines, path)
    assert read(spark, path) == sorted(r.line for r in lines.collect())
    with pytest.raises(AnalysisException):
        sources.write_lines(lines, path)
    packed = str(tmp_path / "packed")
    sources.write_lines(lines, packed, compression="gzip")
    assert read(spark, packed) == read(spark, path)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_records(spark, activity, tmp_path, fmt):
    path = str(tmp_path / fmt)
    sources.write_records(activity, path, fmt)
    back = spark.read.schema(activity.schema).format(fmt).load(path)
    assert sorted(back.collect()) == sorted(activity.collect())


def test_avro_or_a_clear_error(spark, activity, tmp_path):
    path = tmp_path / "avro"
    try:
        sources.write_records(activity, str(path), "avro")
    except AnalysisException as error:
        assert "avro" in str(error).lower()
        assert not path.exists()
    else:
        assert spark.read.format("avro").load(str(path)).count() == 11


def test_truncate_and_append(spark, activity):
    table = records.to_package_table(records.arrivals(activity))
    sources.write_table(table, PACKAGE_TABLE, "truncate", table="package_info")
    sources.write_table(table.where("location = 'AK'"), PACKAGE_TABLE, "truncate", table="package_info")
    assert spark.table("package_info").count() == 2
    sources.write_table(table, PACKAGE_TABLE, "append", table="package_info")
    assert spark.table("package_info").count() == 8
    stored = [(f.name, f.dataType) for f in spark.table("package_info").schema]
    assert stored == [(f.name, f.dataType) for f in PACKAGE_TABLE]
    spark.sql("DROP TABLE package_info")


def test_window_start_is_a_timestamp(spark, activity, tmp_path):
    path = str(tmp_path / "counts")
    counts = windows.to_count_table(windows.windowed_counts(activity))
    sources.write_table(counts, COUNT_TABLE, "truncate", path=path)
    back = spark.read.parquet(path)
    assert dict(back.dtypes) == {"location": "string", "count": "bigint", "timestamp": "timestamp"}
    assert back.agg(F.unix_seconds(F.min("timestamp"))).first()[0] == int(
        datetime(2016, 7, 1, 17, tzinfo=timezone.utc).timestamp()
    )


def test_table_or_path(activity):
    for target in ({}, {"table": "t", "path": "p"}):
        with pytest.raises(ValueError):
            sources.write_table(activity, COUNT_TABLE, "append", **target)


def test_routed_in_one_pass(spark, parsed, activity, tmp_path):
    path = str(tmp_path / "routed")
    sources.write_routed(parsed.select("ok", "value"), "ok", path, fmt="text")
    assert read(spark, f"{path}/ok=false") == sorted(samples.ACTIVITY_LOG[i] for i in (1, 3, 8))
    assert len(read(spark, f"{path}/ok=true")) == 11
    parts = str(tmp_path / "parts")
    sources.write_routed(combine.old_new_trucks(activity), "part", parts)
    assert spark.read.parquet(f"{parts}/part=0").count() == 9
    assert spark.read.parquet(f"{parts}/part=1").count() == 2


def test_many_sinks(spark, activity, tmp_path):
    out = [str(tmp_path / name) for name in ("lines", "mean")]
    counts = aggregates.vip_count_per_location(activity)
    sources.write_many(
        counts,
        lambda df: sources.write_lines(records.format_counts(df, "location"), out[0]),
        lambda df: sources.write_records(aggregates.mean_of(df, "n"), out[1]),
    )
    assert read(spark, out[0]) == ["AK: 2", "BK: 2"]
    assert spark.read.parquet(out[1]).first().mean == 2.0
    assert not counts.is_cached


def test_scratch_paths(spark):
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(p.startswith(shared + "/x-") for p in paths)


def broken(df):
    return df.withColumn("location", F.when(F.col("truckId") < 0, F.col("location")).otherwise(F.raise_error(F.lit("broken off")).cast("string")))


def test_a_failing_replacement_leaves_the_table_whole(spark, activity, tmp_path):
    from waybill.operators import records
    from waybill.sources import files

    table = records.to_package_table(activity)
    sources.write_table(table, PACKAGE_TABLE, "truncate", table="kept_info")
    planned = spark.table("kept_info")
    old = sources.replace_table(table.where("location = 'AK'"), "kept_info")
    assert planned.count() == table.count()  # who has planned reads on
    assert spark.table("kept_info").count() == table.where("location = 'AK'").count()
    files.remove(spark, old)
    with pytest.raises(Exception, match="broken off"):
        sources.write_table(broken(table), PACKAGE_TABLE, "truncate", table="kept_info")
    assert spark.table("kept_info").count() == table.where("location = 'AK'").count()
    sources.write_table(table, PACKAGE_TABLE, "append", table="kept_info")
    assert spark.table("kept_info").count() == table.count() + table.where("location = 'AK'").count()
    spark.sql("DROP TABLE kept_info")
    path = str(tmp_path / "files")
    sources.write_table(table, PACKAGE_TABLE, "truncate", path=path)
    with pytest.raises(Exception, match="broken off"):
        sources.write_table(broken(table), PACKAGE_TABLE, "truncate", path=path)
    assert spark.read.parquet(path).count() == table.count()
    sources.write_table(table.limit(0), PACKAGE_TABLE, "truncate", path=path)
    assert spark.read.parquet(path).count() == 0
    assert [p.name for p in tmp_path.iterdir()] == ["files"]  # nothing is left beside it
    with pytest.raises(ValueError, match="disposition"):
        sources.write_table(table, PACKAGE_TABLE, "merge", path=path)
