"""Streams over staged files: late rows, restarts, open windows, metrics."""

import os

import pytest
from pyspark.sql import functions as F

from waybill import streaming
from waybill.operators import parsing, windows


def stage(folder, name, epochs, mtime, extra=()):
    """One log file; modification times order the files."""
    file = folder / name
    file.write_text("\n".join([*(f"0, AN, {e}, 1, P" for e in epochs), *extra]))
    os.utime(file, (mtime, mtime))


def run(spark, folder, out, checkpoint, files_per_batch=1):
    counts = streaming.stream_windowed_counts(
        streaming.stream_activity(spark, str(folder), files_per_batch)
    )
    query = streaming.stream_to_table(counts, str(checkpoint), path=str(out))
    query.awaitTermination()
    return query


def result(spark, out):
    rows = spark.read.parquet(str(out)).select(F.unix_seconds("window_start"), "n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1] for r in rows}


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder


def test_late_rows_are_dropped_and_counted(spark, folder, tmp_path):
    for i, epochs in enumerate([[1000, 1010, 1061], [1200], [1005, 1199], [9999]]):
        stage(folder, f"f{i}", epochs, 1_000_000 + 100 * i)
    query = run(spark, folder, tmp_path / "out", tmp_path / "cp")
    assert result(spark, tmp_path / "out") == {960: 2, 1020: 1, 1140: 1, 1200: 1}
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1


def test_restart_goes_on_without_repeats(spark, folder, tmp_path):
    out, checkpoint = tmp_path / "out", tmp_path / "cp"
    stage(folder, "f0", [1000, 1010, 1021], 1_000_000)
    run(spark, folder, out, checkpoint)
    assert result(spark, out) == {}  # 1021 - 5 is before the end of the first window
    stage(folder, "f1", [1022, 1200], 1_000_100)
    run(spark, folder, out, checkpoint)
    assert result(spark, out) == {960: 2, 1020: 2}  # counted on from the saved state
    run(spark, folder, out, checkpoint)
    assert result(spark, out) == {960: 2, 1020: 2}


def test_append_to_a_catalog_table(spark, folder, tmp_path):
    stage(folder, "f0", [1000, 1010, 1200], 1_000_000)
    counts = windows.to_count_table(
        streaming.stream_windowed_counts(streaming.stream_activity(spark, str(folder)))
    )
    streaming.stream_to_table(counts, str(tmp_path / "cp"), table="stream_counts").awaitTermination()
    rows = spark.table("stream_counts").select("location", "count", F.unix_seconds("timestamp"))
    assert [tuple(r) for r in rows.collect()] == [("AN", 2, 960)]
    spark.sql("DROP TABLE stream_counts")


def test_invalid_lines_are_counted_in_progress(spark, folder, tmp_path):
    for i in range(2):
        stage(folder, f"f{i}", [1000 + i], 1_000_000 + i, extra=["404 - broken message"] * (i + 1))
    parsed = parsing.parse_activity(streaming.stream_lines(spark, str(folder), 1))
    counted = parsed.observe("lines", F.count_if(~F.col("ok")).alias("invalid"))
    query = streaming.stream_to_table(
        parsing.keep_valid(counted), str(tmp_path / "cp"), path=str(tmp_path / "out")
    )
    query.awaitTermination()
    seen = [p["observedMetrics"]["lines"]["invalid"] for p in query.recentProgress if p["numInputRows"]]
    assert sorted(seen) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_stream_equals_batch(spark, folder, tmp_path):
    stage(folder, "f0", range(0, 4000, 7), 1_000_000)
    activity = parsing.keep_valid(parsing.parse_activity(spark.read.text(str(folder))))
    batch = windows.windowed_counts(activity, "1 minute")
    expected = {r[0]: r[1] for r in batch.select(F.unix_seconds("window_start"), "n").collect()}
    run(spark, folder, tmp_path / "out", tmp_path / "cp")
    last = 3997 - 5
    assert result(spark, tmp_path / "out") == {w: n for w, n in expected.items() if w + 60 <= last}


def test_a_repeated_batch_adds_nothing(spark, folder, tmp_path):
    from waybill.sources import files

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    stage(folder, "f0", [1000, 1010, 1200], 1_000_000)

    def go():
        query = streaming.append_once(streaming.stream_windowed_counts(streaming.stream_activity(spark, str(folder))), checkpoint, out)
        query.awaitTermination()
        return query.lastProgress["batchId"]

    last = go()
    rows = lambda: sorted((r.n, r.location) for r in streaming.read_appended(spark, out).collect())
    assert rows() == [(2, "AN")]
    files.remove(spark, f"{checkpoint}/commits/{last}")
    assert go() == last and rows() == [(2, "AN")]
    # A batch that broke off while writing has no marker and is written anew.
    files.remove(spark, f"{checkpoint}/commits/{last}")
    files.remove(spark, f"{out}/batch_id={last}/_SUCCESS")
    assert go() == last and rows() == [(2, "AN")]
    stage(folder, "f1", [1300], 1_000_100)
    go()
    assert rows() == [(1, "AN"), (2, "AN")]


@pytest.mark.parametrize("rocksdb", [True, False])
def test_open_windows_are_read_from_the_checkpoint(spark, folder, tmp_path, rocksdb):
    stage(folder, "f0", [1000, 1010, 1200, 1201], 1_000_000)
    counts = streaming.stream_windowed_counts(streaming.stream_activity(spark, str(folder)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with streaming.state_settings(spark, rocksdb, 3):
        query = streaming.stream_to_table(counts, str(tmp_path / "cp"), path=str(tmp_path / "out"))
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    held = streaming.open_windows(spark, str(tmp_path / "cp")).select("location", F.unix_seconds("window_start"), "n").collect()
    assert [tuple(r) for r in held] == [("AN", 1200, 2)]


def test_the_clock_closes_the_windows_of_an_idle_stream(spark, folder, tmp_path):
    out = tmp_path / "out"
    stage(folder, "f0", [1000, 1010, 1061, 1200], 1_000_000, extra=["0, BK, 1000, 1, P"])
    counts = streaming.stream_counts_by_clock(streaming.stream_activity(spark, str(folder)), delay_seconds=2)
    with streaming.state_settings(spark, True, 2):
        query = streaming.stream_to_table(counts, str(tmp_path / "cp"), path=str(out), trigger={"processingTime": "500 milliseconds"})
    streaming.stop_when_idle(query, 2)
    rows = lambda: sorted((r.location, int(r.window_start.timestamp()), r.n) for r in spark.read.parquet(str(out)).collect())
    first = [("AN", 960, 2), ("AN", 1020, 1), ("AN", 1200, 1), ("BK", 960, 1)]
    assert rows() == first
    # After a restart a row for a closed window is dropped, one for a new window is not.
    stage(folder, "f1", [1001, 1500], 1_000_100)
    counts = streaming.stream_counts_by_clock(streaming.stream_activity(spark, str(folder)), delay_seconds=2)
    with streaming.state_settings(spark, True, 2):
        query = streaming.stream_to_table(counts, str(tmp_path / "cp"), path=str(out), trigger={"processingTime": "500 milliseconds"})
    streaming.stop_when_idle(query, 2)
    assert rows() == sorted([*first, ("AN", 1500, 1)])


def test_the_clock_keeps_state_for_blocks_of_windows(spark, folder, tmp_path):
    # 600 windows of one location, in a handful of entries of state; before, each had its own, and a timer.
    stage(folder, "f0", [60 * k for k in range(600)], 1_000_000, extra=["0, AN, 59, 1, P", "0, AN, 35999, 1, P"])
    counts = streaming.stream_counts_by_clock(streaming.stream_activity(spark, str(folder)), delay_seconds=2)
    with streaming.state_settings(spark, True, 2):
        query = streaming.stream_to_table(counts, str(tmp_path / "cp"), path=str(tmp_path / "out"), trigger={"processingTime": "500 milliseconds"})
    streaming.stop_when_idle(query, 2)
    found = sorted((int(r.window_start.timestamp()), r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == [(60 * k, 2 if k in (0, 599) else 1) for k in range(600)]
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    assert 0 < held < 60


def test_metrics_of_each_batch_are_files(spark, folder, tmp_path):
    for i, epochs in enumerate([[1000, 1200], [1300], [1001, 1400]]):
        stage(folder, f"f{i}", epochs, 1_000_000 + 100 * i, extra=["broken"] * (i + 1))
    metrics = streaming.MetricsLog(spark, str(tmp_path / "metrics"), "watched")
    spark.streams.addListener(metrics)
    try:
        parsed = parsing.parse_activity(streaming.stream_lines(spark, str(folder), 1))
        counted = parsed.observe("lines", F.count_if(~F.col("ok")).alias("invalid"))
        counts = streaming.stream_windowed_counts(parsing.keep_valid(counted))
        query = streaming.stream_to_table(counts, str(tmp_path / "cp"), path=str(tmp_path / "out"), name="watched")
        query.awaitTermination()
        metrics.wait(query)
    finally:
        spark.streams.removeListener(metrics)
    found = streaming.read_metrics(spark, str(tmp_path / "metrics"), "lines: struct<invalid: bigint>").where("rows > 0").orderBy("batch")
    assert [(r["rows"], r.observed.lines.invalid, r.late) for r in found.collect()] == [(3, 1, 0), (3, 2, 0), (5, 3, 1)]
