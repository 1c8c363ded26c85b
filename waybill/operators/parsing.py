"""Parsing of log lines, reject routing and the invalid-line counter.

A parser adds columns to a frame of lines (``value``): ``ok``, ``reject_reason``
and the record's fields. No line is dropped until the caller says so.

One regular expression settles the shape of a line before anything is cast, so
``try_cast`` (which throws and catches inside) only ever fails on overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from waybill.functions import WHOLE_NUMBER, epoch_to_time, strip_blanks
from waybill.schema import LEGACY_LOCATION

LINE = "value"
STATUS = (LINE, "ok", "reject_reason")

# Commas after the last non-empty piece do not start new pieces.
LAST_PIECE = r"[^,]++,*+\z"
ACTIVITY_SHAPE = rf"^{WHOLE_NUMBER},[^,]*+,{WHOLE_NUMBER},{WHOLE_NUMBER},{LAST_PIECE}"
LEGACY_SHAPE = rf"^{WHOLE_NUMBER},{WHOLE_NUMBER},{LAST_PIECE}"
# Space-separated, no trimming; pieces after the second are ignored.
CALL_SHAPE = r"(?s)^[^ ]*+ [+-]?[0-9]++(?: .*+)?\z"


def _pieces(shape: str, separator: str) -> Column:
    """The pieces of a line that has the wanted shape, else NULL."""
    line = F.col(LINE)
    return F.when(line.rlike(shape), F.split(F.rtrim(line, F.lit(separator)), separator))


def _piece(index: int) -> Column:
    return F.get("pieces", F.lit(index))


def _judge(frame: DataFrame, reasons: list[tuple[Column, str]], fields: list[Column]) -> DataFrame:
    """Add ``ok`` and ``reject_reason``: the first failing check names the reason."""
    reason = F.lit(None).cast("string")
    good = F.lit(True)
    for bad, name in reversed(reasons):
        reason = F.when(bad, F.lit(name)).otherwise(reason)
        good = good & ~bad
    return frame.select(LINE, good.alias("ok"), reason.alias("reject_reason"), *fields)


def parse_activity(lines: DataFrame) -> DataFrame:
    """``flag, location, epoch_s, truck, package`` to activity records.

    Exactly five comma-separated pieces, blanks around each dropped; the flag is
    the number 0 (departure) or 1 (arrival). An empty location or package is
    accepted. Non-ASCII digits and times outside years 1-9999 are rejected.
    """
    frame = lines.select(LINE, _pieces(ACTIVITY_SHAPE, ",").alias("pieces")).select(
        LINE,
        F.col("pieces").isNotNull().alias("shaped"),
        _piece(0).try_cast("int").alias("flag"),
        strip_blanks(_piece(1)).alias("location"),
        _piece(2).try_cast("bigint").alias("epoch"),
        _piece(3).try_cast("int").alias("truck_id"),
        strip_blanks(_piece(4)).alias("package_id"),
    ).withColumn("event_time", epoch_to_time(F.col("epoch")))
    return _judge(
        frame,
        [
            (~F.col("shaped"), "malformed"),
            (~F.coalesce(F.col("flag").isin(0, 1), F.lit(False)), "flag"),
            (F.col("event_time").isNull(), "time range"),
            (F.col("truck_id").isNull(), "truck range"),
        ],
        [
            (F.col("flag") == 1).alias("is_arrival"),
            F.col("location"),
            F.col("event_time"),
            F.col("truck_id"),
            F.col("package_id"),
        ],
    )


def parse_legacy_activity(lines: DataFrame) -> DataFrame:
    """``epoch_s, truck, package`` of the one-location days to activity records.

    Every line is a departure at the one location there was. This follows the
    documented layout of the old log; a parser that looks for five pieces in
    three-piece lines could not accept any of them.
    """
    frame = lines.select(LINE, _pieces(LEGACY_SHAPE, ",").alias("pieces")).select(
        LINE,
        F.col("pieces").isNotNull().alias("shaped"),
        _piece(0).try_cast("bigint").alias("epoch"),
        _piece(1).try_cast("int").alias("truck_id"),
        strip_blanks(_piece(2)).alias("package_id"),
    ).withColumn("event_time", epoch_to_time(F.col("epoch")))
    return _judge(
        frame,
        [
            (~F.col("shaped"), "malformed"),
            (F.col("event_time").isNull(), "time range"),
            (F.col("truck_id").isNull(), "truck range"),
        ],
        [
            F.lit(False).alias("is_arrival"),
            F.lit(LEGACY_LOCATION).alias("location"),
            F.col("event_time"),
            F.col("truck_id"),
            F.col("package_id"),
        ],
    )


def parse_support_calls(lines: DataFrame) -> DataFrame:
    """``location epoch_s`` to support calls."""
    frame = lines.select(LINE, _pieces(CALL_SHAPE, " ").alias("pieces")).select(
        LINE,
        F.col("pieces").isNotNull().alias("shaped"),
        _piece(0).alias("location"),
        _piece(1).try_cast("bigint").alias("call_epoch"),
    )
    return _judge(
        frame,
        [(~F.col("shaped"), "malformed"), (F.col("call_epoch").isNull(), "time range")],
        [F.col("location"), F.col("call_epoch")],
    )


def parse_location_names(lines: DataFrame, full_name: bool = False) -> DataFrame:
    """``code name words...`` to names: the second word, or all words on request."""
    line = F.rtrim(LINE)
    frame = lines.select(LINE, line.alias("line"), F.split(line, " ").alias("pieces"))
    name = F.col("line").substr(F.length(_piece(0)) + 2, F.length("line")) if full_name else _piece(1)
    return _judge(
        frame,
        [(F.coalesce(F.size("pieces") < 2, F.lit(True)), "malformed")],
        [_piece(0).alias("location"), name.alias("name")],
    )


def _flat_map(parsed: DataFrame, wanted: Column, columns: list[str]) -> DataFrame:
    """The given columns of the wanted lines: zero or one row per line.

    An ``explode`` and not a ``where``: a filter would be pushed below the parse,
    which would then run once for the filter and once more for the output.
    """
    row = F.struct(*[F.col(c) for c in columns])
    return parsed.select(F.explode(F.when(wanted, F.array(row))).alias("row")).select("row.*")


def keep_valid(parsed: DataFrame, *columns: str) -> DataFrame:
    """The records of the lines that parsed, or the given columns of them; others are then not parsed."""
    wanted = list(columns) or [c for c in parsed.columns if c not in STATUS]
    return _flat_map(parsed, F.col("ok"), wanted)


def keep_rejects(parsed: DataFrame) -> DataFrame:
    """The raw lines that did not parse, with the reason."""
    return _flat_map(parsed, ~F.col("ok"), [LINE, "reject_reason"])


def split_valid_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines) of one parse.

    Each is its own plan. To write both from a single read of the input use
    ``write_routed`` on the parsed frame.
    """
    return keep_valid(parsed), keep_rejects(parsed)


def with_invalid_counter(
    parsed: DataFrame, name: str = "invalid_lines"
) -> tuple[DataFrame, Observation]:
    """The frame, and a counter filled by whichever action runs it first.

    Unlike an accumulator it is right when tasks are retried.
    """
    counter = Observation(name)
    return parsed.observe(counter, F.count_if(~F.col("ok")).alias(name)), counter


def count_invalid(parsed: DataFrame) -> DataFrame:
    """The number of rejected lines as a one-row frame."""
    return parsed.agg(F.count_if(~F.col("ok")).alias("n"))
