"""The activity inputs, rendered as text lines from the ``events`` table.

There is no activity log among the tables, so every event is written as a log
line the way a package system would have written it, mess included, and the
queries parse the lines back:

* an ``error`` event is a broken line (and a support call for its location);
* a reading below 10 cuts the line short after the truck;
* purchases and sign-ups are arrivals, all else departures;
* readings of 75 and more are VIP packages, but not at ``L2``;
* by their number, some events have odd flags, tabs, commas at the end, times and
  trucks out of range, an empty location or a blank package;
* ``L25`` to ``L28`` and ``L3`` have no name, ``L1`` no call, ``C0`` calls only;
* old-log and call lines are broken in their own ways, by number too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.operators import parsing


def utc_time(df: DataFrame, column: str) -> Column:
    """A zone-less column as the instant with that UTC wall clock."""
    if dict(df.dtypes)[column] != "timestamp_ntz":
        return F.col(column)
    return F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone())


LOCATIONS = 29
LATE_TIME, ENDLESS_TIME, LARGE_TRUCK = "253402300800", "99999999999999999999", "2147483648"


def _location() -> Column:
    return F.concat(F.lit("L"), F.col("user_id") % LOCATIONS)


def _epoch(events: DataFrame) -> Column:
    return F.unix_seconds(utc_time(events, "ts"))


def _package() -> Column:
    vip = (F.col("value") >= 75) & (F.col("user_id") % LOCATIONS != 2)
    return F.concat(F.when(vip, "VIP").otherwise("PKG"), F.col("event_id") % 1000)


def _odd(number: Column, odd: dict[int, Column | str], usual: Column) -> Column:
    """The usual text, or another for the numbers listed."""
    text = usual.cast("string")
    for k, other in odd.items():
        text = F.when(number == k, other if isinstance(other, Column) else F.lit(other)).otherwise(text)
    return text


def activity_lines(events: DataFrame) -> DataFrame:
    kind = F.col("event_id") % 41
    flag = _odd(kind, {1: "01", 2: "+1", 3: "-0", 4: "2"}, F.when(F.col("event_type").isin("purchase", "signup"), "1").otherwise("0"))
    location = _odd(kind, {10: ""}, _location())
    time = _odd(kind, {7: LATE_TIME, 8: ENDLESS_TIME}, _epoch(events))
    truck = _odd(kind, {9: LARGE_TRUCK}, F.col("user_id") * 4)
    package = _odd(kind, {11: " "}, _package())
    comma = _odd(kind, {5: "\t,\t"}, F.lit(", "))
    start = F.concat(flag, comma, location, comma, time, comma, truck)
    broken = _odd(F.col("event_id") % 4, {1: ",,,", 2: "", 3: "1, L3, 17, x4, P"}, F.lit("no record here"))
    return events.select(
        F.when(F.col("event_type") == "error", broken)
        .when(F.col("value") < 10, F.concat(start, F.lit("######")))
        .otherwise(F.concat(start, comma, package, _odd(kind, {6: ",,"}, F.lit(""))))
        .alias("value")
    )


def legacy_lines(events: DataFrame) -> DataFrame:
    kind = F.col("event_id") % 17
    time, truck = _odd(kind, {3: LATE_TIME}, _epoch(events)), _odd(kind, {2: LARGE_TRUCK}, F.col("user_id") * 4)
    end = _odd(kind, {0: "", 1: F.concat(F.lit(", "), _package(), F.lit(", more"))}, F.concat(F.lit(", "), _package()))
    return events.select(F.concat(time, F.lit(", "), truck, end).alias("value"))


def call_lines(events: DataFrame) -> DataFrame:
    kind, place = F.col("event_id") % 13, F.col("user_id") % LOCATIONS
    location = F.when(place == 0, "C0").otherwise(_location())
    # Nobody calls from L1: its lines lack the time.
    time = F.when(place == 1, "").otherwise(_odd(kind, {0: "", 1: " soon", 2: " " + ENDLESS_TIME}, F.concat(F.lit(" "), _epoch(events))))
    return events.where(F.col("event_type") == "error").select(F.concat(location, time).alias("value"))


def name_lines(nation: DataFrame) -> DataFrame:
    name = F.when(F.col("n_nationkey") == 3, "").otherwise(F.concat(F.lit(" "), F.col("n_name"), F.lit(" Warehouse")))
    return nation.select(F.concat(F.lit("L"), F.col("n_nationkey"), name).alias("value"))


class EventLog:
    """The inputs of all queries over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def lines(self) -> DataFrame:
        return activity_lines(self.table("events"))

    @property
    def parsed(self) -> DataFrame:
        return parsing.parse_activity(self.lines)

    @property
    def activity(self) -> DataFrame:
        return parsing.keep_valid(self.parsed)

    @property
    def legacy(self) -> DataFrame:
        return parsing.keep_valid(parsing.parse_legacy_activity(legacy_lines(self.table("events"))))

    @property
    def calls(self) -> DataFrame:
        return parsing.keep_valid(parsing.parse_support_calls(call_lines(self.table("events"))))

    @property
    def names(self) -> DataFrame:
        return parsing.keep_valid(parsing.parse_location_names(name_lines(self.table("nation"))))

    @property
    def streamed_lines(self) -> DataFrame:
        schema = self.table("events").schema
        # As a pattern the path may name one file as well as a folder of files.
        events = self.spark.readStream.schema(schema).parquet(f"{self.folder}/events.parque[t]")
        return activity_lines(events)
