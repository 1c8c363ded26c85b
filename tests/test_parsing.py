"""Edge lines, and random lines against a plain statement of the rules."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill import sources
from waybill.operators import parsing

BLANKS = "".join(map(chr, range(33)))
MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300799


def whole(text, bits):
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    number = int(text)
    return number if -(2 ** (bits - 1)) <= number < 2 ** (bits - 1) else None


def pieces_of(line):
    pieces = line.split(",")
    while pieces and pieces[-1] == "":
        pieces.pop()
    return [p.strip(BLANKS) for p in pieces]


def expected(line):
    pieces = pieces_of(line)
    if len(pieces) != 5:
        return None
    flag, epoch, truck = whole(pieces[0], 32), whole(pieces[2], 64), whole(pieces[3], 32)
    if flag not in (0, 1) or epoch is None or truck is None:
        return None
    if not MIN_EPOCH <= epoch <= MAX_EPOCH:
        return None
    return (flag == 1, pieces[1], epoch, truck, pieces[4])


def expected_legacy(line):
    pieces = pieces_of(line)
    if len(pieces) != 3:
        return None
    epoch, truck = whole(pieces[0], 64), whole(pieces[1], 32)
    if epoch is None or truck is None or not MIN_EPOCH <= epoch <= MAX_EPOCH:
        return None
    return (False, "AR", epoch, truck, pieces[2])


def parse_all(spark, lines, parser=parsing.parse_activity):
    numbered = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    parsed = parser(numbered.select("value"))
    rows = parsed.withColumn("event_time", F.unix_seconds("event_time")).collect()
    assert len(rows) == len(lines)
    assert all((r.reject_reason is None) == r.ok for r in rows)
    return {r.value: tuple(r)[3:] if r.ok else None for r in rows}


@pytest.mark.parametrize(
    "line, result",
    [
        ("0,AN,1,2,P,,", (False, "AN", 1, 2, "P")),
        ("0,AN,1,2,", None),
        ("0,AN,1,2, ", (False, "AN", 1, 2, "")),
        ("0,,1,2,P", (False, "", 1, 2, "P")),
        ("+1,AN,1,2,P", (True, "AN", 1, 2, "P")),
        ("01,AN,1,2,P", (True, "AN", 1, 2, "P")),
        ("-0,AN,1,2,P", (False, "AN", 1, 2, "P")),
        ("2,AN,1,2,P", None),
        ("0,AN,1.5,2,P", None),
        ("0,AN,1e3,2,P", None),
        ("0,AN,1,2147483648,P", None),
        ("0,AN,1,-2147483648,P", (False, "AN", 1, -2147483648, "P")),
        ("0,AN,-1,2,P", (False, "AN", -1, 2, "P")),
        ("0,AN,9223372036855,2,P", None),
        ("0,AN,99999999999999999999,2,P", None),
        ("\t0,AN,1,2,P\t", (False, "AN", 1, 2, "P")),
        ("0,\tA N\x01,1,2,\x02P Q\x03", (False, "A N", 1, 2, "P Q")),
        ("0,AN,1,2\x7f,P", None),
        ("0,AN,1,2,P,Q", None),
        ("0,AN,,1,2,P", None),
        ("", None),
        (",,,", None),
        (",0,AN,1,2,P", None),
        ("+,AN,1,2,P", None),
        ("0,AN,١,2,P", None),
        ("0,ÅN,1,2,世", (False, "ÅN", 1, 2, "世")),
    ],
)
def test_edge_line(spark, line, result):
    assert expected(line) == result
    assert parse_all(spark, [line])[line] == result


def test_reasons(spark):
    lines = {
        "x": "malformed",
        "3,AN,1,2,P": "flag",
        "99999999999,AN,1,2,P": "flag",
        "0,AN,253402300800,2,P": "time range",
        "0,AN,1,2147483648,P": "truck range",
    }
    parsed = parsing.parse_activity(sources.lines_from_values(spark, list(lines)))
    assert {r.value: r.reject_reason for r in parsing.keep_rejects(parsed).collect()} == lines


blank = st.text(st.sampled_from(" \t\x00\x1f\x0b"), max_size=2)
number = st.one_of(
    st.sampled_from(["0", "1", "+1", "-0", "01", "2", "", "+", "1.5", "1e3", "0x1", "1L", "1_0"]),
    st.integers(-(2**33), 2**33).map(str),
    st.integers(-(2**65), 2**65).map(str),
    st.sampled_from(["1\x7f", "\x7f1", "1\x85", "1\xa0", "1 2", "١", "2147483647", "-2147483648"]),
)
word = st.text(st.characters(exclude_categories=["Cs"], exclude_characters=","), max_size=4)
padded = st.tuples(blank, st.one_of(number, word), blank).map("".join)
good = st.tuples(
    st.sampled_from(["0", "1", " 1", "+0"]), word, st.integers(-(10**11), 10**11).map(str),
    st.integers(-(2**31), 2**31).map(str), word,
).map(", ".join)
line = st.one_of(good, st.lists(padded, max_size=7).map(",".join), st.text(st.sampled_from("01, ,aA\t-+"), max_size=14))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(line, min_size=300, max_size=400, unique=True))
def test_random_lines(spark, lines):
    assert parse_all(spark, lines) == {text: expected(text) for text in lines}


legacy_line = st.one_of(
    st.lists(padded, min_size=2, max_size=4).map(",".join),
    st.tuples(st.integers(-(10**11), 10**11).map(str), st.integers(0, 2**31).map(str), word).map(", ".join),
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(legacy_line, min_size=200, max_size=300, unique=True))
def test_random_legacy_lines(spark, lines):
    assert parse_all(spark, lines, parsing.parse_legacy_activity) == {
        text: expected_legacy(text) for text in lines
    }


def test_valid_and_rejects_are_all(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        F.explode(F.split("text", "\n")).alias("value")
    )
    valid, rejects = parsing.split_valid_rejects(parsing.parse_activity(lines))
    assert valid.count() + rejects.count() == lines.count()


@pytest.mark.parametrize(
    "line, result",
    [
        ("AK 1467395123", ("AK", 1467395123)),
        ("AK 1467395123 ", ("AK", 1467395123)),
        ("AK 1467395123 by phone", ("AK", 1467395123)),
        (" 5", ("", 5)),
        ("AK  5", None),
        ("AK", None),
        ("AK x", None),
        ("AK 5\t", None),
        ("AK 99999999999999999999", None),
        ("", None),
    ],
)
def test_support_calls(spark, line, result):
    row = parsing.parse_support_calls(sources.lines_from_values(spark, [line])).first()
    assert ((row.location, row.call_epoch) if row.ok else None) == result


@pytest.mark.parametrize(
    "line, name, full",
    [
        ("AN Annapolis Warehouse", "Annapolis", "Annapolis Warehouse"),
        ("AN Annapolis  ", "Annapolis", "Annapolis"),
        ("AN  X", "", " X"),
        ("AN", None, None),
        ("AN ", None, None),
        ("", None, None),
    ],
)
def test_location_names(spark, line, name, full):
    lines = sources.lines_from_values(spark, [line])
    for option, wanted in ((False, name), (True, full)):
        row = parsing.parse_location_names(lines, option).first()
        assert (row.name if row.ok else None) == wanted


def test_null_lines_are_rejects(spark):
    lines = spark.sql("SELECT CAST(NULL AS STRING) AS value")
    for parser in (
        parsing.parse_activity,
        parsing.parse_legacy_activity,
        parsing.parse_support_calls,
        parsing.parse_location_names,
    ):
        assert [r.ok for r in parser(lines).collect()] == [False]
