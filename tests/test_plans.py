"""What the physical plans must and must not contain."""

import re

import pytest

from waybill.operators import aggregates, combine, locations, parsing, records, windows
from waybill.plans import catalog

FOLDER = "/root/testdata/sf0.001"
EAGER = {name for name in catalog.queries() if name.startswith("stream_")} | {
    "text_log_files", "legacy_log_files", "location_files", "activity_text_files", "record_files",
    "package_table_truncate", "count_table_append", "routed_lines", "several_sinks",
    "invalid_line_metric", "location_report_text", "records_and_rejects_text", "old_new_text",
    "partitions_from_one_pass", "activity_numbered_with_calls", "package_table_replaced",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hashpart|rangepart|Single|RoundRobin)", plan))


@pytest.fixture(scope="module")
def activity(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "lines")
    from waybill import sources
    from waybill.plans.eventlog import EventLog

    sources.write_lines(EventLog(spark, FOLDER).lines, path)
    return sources.read_activity(spark, path)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - EAGER))
def test_no_cross_joins_and_no_python_rows(spark, name):
    plan = plan_of(catalog.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInPandas" in plan) == (name == "par_do_tags")


@pytest.mark.parametrize("name", ["support_calls_per_location", "parse_support_calls"])
def test_scan_is_pruned_and_filtered(spark, name):
    plan = plan_of(catalog.queries()[name](spark, FOLDER))
    assert "EqualTo(event_type,error)" in plan
    assert "props" not in plan and "value:double" not in plan


def test_lines_are_parsed_once(spark, activity):
    parsed = parsing.parse_activity(spark.read.text(activity.inputFiles()))
    frames = [
        activity,
        parsing.keep_rejects(parsed),
        parsing.count_invalid(parsed),
        records.arrivals(activity),
        records.vip_only(activity),
        aggregates.vip_count_per_location(activity),
        windows.windowed_counts(activity),
    ]
    for frame in frames:
        assert plan_of(frame).count("RLIKE") == 1


@pytest.mark.parametrize(
    "build, count",
    [
        (lambda a: a, 0),
        (records.format_activity, 0),
        (aggregates.vip_count_per_location, 1),
        (aggregates.unique_vip_per_location, 2),
        (aggregates.mean_vip_per_location, 2),
        (aggregates.packages_per_truck, 1),
        (windows.windowed_counts, 1),
        (windows.hourly_counts, 1),
        (lambda a: locations.location_activity_with_calls(a, a.select("location")), 2),
    ],
)
def test_number_of_shuffles(activity, build, count):
    assert shuffles(plan_of(build(activity))) == count


def test_aggregates_combine_before_the_shuffle(activity):
    for frame in (aggregates.vip_count_per_location(activity), windows.windowed_counts(activity)):
        plan = plan_of(frame)
        assert plan.count("partial_count") == 1
        assert plan.index("Exchange") < plan.index("partial_count")


def test_truck_text_is_one_range_sort(activity):
    plan = plan_of(aggregates.packages_per_truck_text(activity))
    assert shuffles(plan) == 1 and plan.count("rangepartitioning") == 1
    assert "Join" not in plan


def test_frames_behind_the_sinks(spark, activity):
    """What the sinks write: one parse and one scan, no shuffle of raw rows."""
    parsed = parsing.parse_activity(spark.read.text(activity.inputFiles()))
    counted, _ = parsing.with_invalid_counter(parsed, "plan_counter")
    parts = combine.old_new_trucks(activity)
    for frame in (
        records.records_and_rejects(parsed),
        parsing.keep_valid(counted),
        parsed.select("ok", "value"),
        parts.select("part", records.activity_line()),
        records.to_package_table(records.arrivals(activity)),
    ):
        plan = plan_of(frame)
        assert plan.count("RLIKE") == 1 and plan.count("FileScan text") == 1
        assert shuffles(plan) == 0


def test_unused_fields_are_not_parsed(spark, activity):
    parsed = parsing.parse_activity(spark.read.text(activity.inputFiles()))
    two = plan_of(parsing.keep_valid(parsed, "truck_id", "package_id"))
    assert "location" not in two and "is_arrival" not in two
    assert plan_of(parsing.keep_valid(parsed).select("truck_id", "package_id")) != two


def test_report_events_are_not_shuffled(activity):
    names = activity.sparkSession.createDataFrame([("L1", "One")], "location string, name string")
    report = locations.location_report_lines(activity, activity.select("location"), names)
    frames, events = plan_of(report).split("\n   +- ")  # the two children of the union
    # Totals, calls, names and the joined totals: rows per location, not per event.
    assert shuffles(frames) == 4
    assert "Scan text" in events or "FileScan text" in events
    assert shuffles(events) == 0


def test_staged_parts_are_one_pass_and_read_their_own_folder(spark, activity, tmp_path):
    parted = combine.old_new_trucks(activity)
    assert plan_of(parted).count("RLIKE") == 1
    for i, part in enumerate(combine.staged_partitions(parted, 2, str(tmp_path / "parts"))):
        plan = plan_of(part)
        assert "RLIKE" not in plan and "part#" in plan and f"= {i})" in plan.split("PartitionFilters")[1]
        assert shuffles(plan) == 0
