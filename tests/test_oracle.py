"""Every registered query against its SQL on all rows of a table set."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tests.compare import duck_rows, spark_rows
from waybill.plans import catalog, oracle

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert catalog.queries().keys() == oracle.oracle_sql().keys()
    assert contract.queries().keys() >= catalog.queries().keys()
    assert contract.oracle_sql().keys() >= catalog.queries().keys()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    columns, rows = spark_rows(catalog.queries()[name](spark, FOLDER))
    expected_columns, expected = duck_rows(duck, oracle.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_the_log_has_all_kinds_of_trouble(spark):
    """Rejects of every reason, keys on one side only, missing names, zero counts and late rows occur."""
    rows = lambda name: catalog.queries()[name](spark, FOLDER)
    assert {r.reject_reason for r in rows("rejected_lines").collect()} == {"malformed", "flag", "time range", "truck range"}
    assert {r.log for r in rows("rejected_other_lines").collect()} == {"legacy", "calls", "names"}
    joined = rows("location_activity_with_calls")
    assert joined.where("events = 0").count() and joined.where("calls = 0").count() and joined.where("name IS NULL").count()
    assert rows("activity_with_location_name").where("name IS NULL").count()
    assert rows("unique_vip_per_location").where("n = 0").count()
    late, all_rows = (rows(n).agg({"n": "sum"}).first()[0] for n in ("stream_counts_late", "stream_counts_1m_append"))
    assert late < all_rows


def test_report_text_is_in_order_in_its_files(spark, tmp_path):
    from waybill import sources

    path = tmp_path / "report"
    sources.write_lines(catalog.queries()["location_report_text"](spark, FOLDER), str(path))
    lines = [line for file in sorted(path.glob("part-*")) for line in file.read_text().split("\n")[:-1]]
    ends = [k for k, line in enumerate(lines) if line.startswith("End ")]
    places = [lines[k][4:].rstrip("*") for k in ends]
    assert places == sorted(places) and ends[-1] == len(lines) - 1
    for start, end, place in zip([0, *(e + 1 for e in ends)], ends, places):
        assert lines[start] == place + "*" * 10 and lines[start + 1].startswith("Location: ")
        assert lines[start + 2].startswith("Total # Support Calls: ")
        assert all(line.startswith(("Arrived: ", "Departed: ")) for line in lines[start + 3 : end])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
