"""Small samples with results worked out by hand."""

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests import samples
from waybill import sources
from waybill.operators import aggregates, combine, locations, parsing, records, windows


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The samples as text files; the last line has no newline."""
    folder = tmp_path_factory.mktemp("logs")
    for name in ("ACTIVITY_LOG", "LEGACY_LOG", "CALL_LOG", "NAME_MAP"):
        (folder / name).write_text("\n".join(getattr(samples, name)))
    return folder


@pytest.fixture(scope="module")
def activity(spark, inputs):
    return sources.read_activity(spark, str(inputs / "ACTIVITY_LOG"))


@pytest.fixture(scope="module")
def legacy(spark, inputs):
    return sources.read_legacy_activity(spark, str(inputs / "LEGACY_LOG"))


@pytest.fixture(scope="module")
def calls(spark, inputs):
    return sources.read_support_calls(spark, str(inputs / "CALL_LOG"))


@pytest.fixture(scope="module")
def names(spark, inputs):
    return sources.read_location_names(spark, str(inputs / "NAME_MAP"))


def pairs(df):
    return {row[0]: row[1] for row in df.collect()}


def utc(df, column):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


def test_parse(spark, inputs, activity):
    lines = sources.read_lines(spark, str(inputs / "ACTIVITY_LOG"))
    assert lines.count() == 14
    valid, rejects = parsing.split_valid_rejects(parsing.parse_activity(lines))
    assert valid.count() == 11
    assert Counter(r.value for r in rejects.collect()) == Counter(
        samples.ACTIVITY_LOG[i] for i in (1, 3, 8)
    )
    first = utc(activity, "event_time").first()
    assert tuple(first) == (False, "AN", "2016-07-01 17:28:42", 423, "372A3SZ4J98")


def test_literal_lines_and_counter(spark):
    parsed, counter = parsing.with_invalid_counter(
        parsing.parse_activity(sources.lines_from_values(spark, samples.MINI_LOG))
    )
    valid = parsing.keep_valid(parsed).collect()
    assert len(valid) == 2 and valid[0] == valid[1]
    assert counter.get == {"invalid_lines": 2}


def test_legacy(legacy):
    rows = legacy.collect()
    assert sorted(r.truck_id for r in rows) == [103, 423, 543, 543]
    assert {(r.is_arrival, r.location) for r in rows} == {(False, "AR")}


def test_arrivals_and_table(activity):
    table = records.to_package_table(records.arrivals(activity))
    assert table.columns == ["packageId", "location", "truckId", "timestamp"]
    assert table.count() == 6


def test_vip(activity):
    assert pairs(aggregates.unique_vip_per_location(activity)) == {"AK": 1, "AN": 0, "BK": 2}
    counts = aggregates.vip_count_per_location(activity)
    assert pairs(counts) == {"AK": 2, "BK": 2}
    lines = records.format_counts(counts, "location").collect()
    assert sorted(r.line for r in lines) == ["AK: 2", "BK: 2"]
    assert aggregates.mean_vip_per_location(activity).first().mean == 2.0
    assert aggregates.mean_of(counts.where("n < 0"), "n").first().mean is None


def test_activity_text(activity):
    line = records.format_activity(activity).first().line
    assert line == "PackageActivityInfo [isArrival=false, location=AN, packageId=372A3SZ4J98]"


def test_packages_per_truck(activity):
    counts = {(r.truck_id, r.package_id): r.copies for r in aggregates.packages_per_truck(activity).collect()}
    assert counts == {
        (12, "320893JSEFE"): 2,
        (19, "3JISE23423J"): 1,
        (19, "VIP34HWINF"): 1,
        (19, "VIP3JISE234"): 1,
        (42, "372A3SZ4J98"): 1,
        (102, "VIP320893JSEFE"): 2,
        (190, "3JISE23423J"): 1,
        (423, "372A3SZ4J98"): 2,
    }
    lines = [r.line for r in aggregates.packages_per_truck_text(activity).collect()]
    assert lines == [
        "12: 320893JSEFE", "12: 320893JSEFE", "19: 3JISE23423J", "19: VIP34HWINF", "19: VIP3JISE234", "42: 372A3SZ4J98",
        "102: VIP320893JSEFE", "102: VIP320893JSEFE", "190: 3JISE23423J", "423: 372A3SZ4J98", "423: 372A3SZ4J98",
    ]


def test_hours_and_windows(activity):
    assert pairs(utc(windows.hourly_counts(activity), "hour")) == {
        "2016-07-01 17:00:00": 6,
        "2016-07-02 21:00:00": 5,
    }
    lines = records.format_hourly_counts(windows.hourly_counts(activity)).collect()
    assert "Fri Jul 01 17:00:00 UTC 2016: 6" in {r.line for r in lines}
    lines = records.format_windowed_counts(windows.windowed_counts(activity)).collect()
    assert {r.line for r in lines} == {
        "AK: 3 2016-07-01T17:00:00.000Z",
        "AN: 3 2016-07-01T17:00:00.000Z",
        "AK: 1 2016-07-02T21:00:00.000Z",
        "BK: 4 2016-07-02T21:00:00.000Z",
    }


def test_hours_of_other_zones(spark):
    # Two instants an hour apart that share a wall-clock hour at the end of summer time.
    times = spark.sql("SELECT timestamp_seconds(s) AS event_time FROM VALUES (1477787400L), (1477791000L) AS t(s)")
    berlin = windows.hourly_counts(times, "Europe/Berlin").select(F.unix_seconds("hour"), "n")
    assert sorted(map(tuple, berlin.collect())) == [(1477785600, 1), (1477789200, 1)]
    text = records.format_hourly_counts(windows.hourly_counts(times, "Europe/Berlin"), "Europe/Berlin")
    assert sorted(r.line for r in text.collect()) == ["Sun Oct 30 02:00:00 CEST 2016: 1", "Sun Oct 30 02:00:00 CET 2016: 1"]
    kolkata = windows.hourly_counts(times, "Asia/Kolkata").select(F.unix_seconds("hour"), "n")
    assert sorted(map(tuple, kolkata.collect())) == [(1477787400, 1), (1477791000, 1)]


def test_old_new_split(activity, legacy):
    old, new = combine.split_partitions(combine.old_new_trucks(activity), 2)
    assert (old.count(), new.count()) == (9, 2)
    both = combine.union_activity(activity, legacy)
    old, new = combine.split_partitions(combine.old_new_trucks(both), 2)
    assert (old.count(), new.count()) == (10, 5)
    assert old.columns == activity.columns


def test_partition_out_of_range(activity):
    for bad in (F.lit(2), F.lit(-1), F.lit(None).cast("int")):
        with pytest.raises(PySparkException, match="partition not in"):
            combine.partition_activity(activity, 2, bad).collect()


def test_calls_and_names(activity, calls, names):
    rows = locations.location_activity_with_calls(activity, calls, names).collect()
    assert {tuple(r) for r in rows} == {
        ("AK", 4, 2, 3, "Alaska"),
        ("AN", 3, 1, 1, "Annapolis"),
        ("BK", 4, 3, 3, "Bangkok"),
    }


def test_locations_in_one_input_only(activity, calls, names):
    quiet = locations.location_activity_with_calls(activity, calls.where("location <> 'AN'"), names)
    assert tuple(quiet.where("location = 'AN'").first()) == ("AN", 3, 1, 0, "Annapolis")
    empty = locations.location_activity_with_calls(activity.where("location <> 'AN'"), calls, names)
    assert tuple(empty.where("location = 'AN'").first()) == ("AN", 0, 0, 1, "Annapolis")
    report = locations.location_report_lines(activity, calls, names.where("location <> 'AN'"))
    assert report.where("location = 'AN' AND section = 1").first().line == "Location: null"


def test_full_names(spark, inputs):
    full = sources.read_location_names(spark, str(inputs / "NAME_MAP"), full_name=True)
    assert pairs(full)["AN"] == "Annapolis Warehouse"


def test_duplicate_codes_fail(activity, names):
    with pytest.raises(PySparkException, match="duplicate location code: AK"):
        locations.with_location_name(activity, names.union(names.where("location = 'AK'"))).collect()


def test_report(activity, calls, names):
    text = locations.location_report_text(locations.location_report_lines(activity, calls, names))
    lines = [r.line for r in text.collect()]
    start = lines.index("AN**********")
    assert lines[start : start + 7] == [
        "AN**********",
        "Location: Annapolis",
        "Total # Support Calls: 1",
        "Departed: 372A3SZ4J98",
        "Arrived: 372A3SZ4J98",
        "Departed: 372A3SZ4J98",
        "End AN******",
    ]
    assert len(lines) == 11 + 3 * 4
