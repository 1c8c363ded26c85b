"""Time column helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of 0001-01-01 and 9999-12-31T23:59:59, the range a TIMESTAMP prints.
MIN_EPOCH = -62135596800
MAX_EPOCH = 253402300799

HOUR_MICROS = 3_600_000_000


def epoch_to_time(seconds: Column) -> Column:
    """Epoch seconds to TIMESTAMP; NULL outside years 1-9999.

    The range test sits inside the conversion: ``timestamp_seconds`` fails the
    job on overflow, and a separate filter might be evaluated after it.
    """
    return F.timestamp_seconds(F.when(seconds.between(MIN_EPOCH, MAX_EPOCH), seconds))


def time_to_millis(time: Column) -> Column:
    """Milliseconds since the epoch, rounded down; NULL stays NULL."""
    return F.unix_millis(time)


def hour_start(time: Column, tz: str | None = None) -> Column:
    """Start of the wall-clock hour of ``tz`` (default: the session's zone).

    Only the minutes past the local hour are taken off, so the result stays an
    instant: the two hours with one wall-clock name at the end of daylight
    saving remain apart.
    """
    local = F.from_utc_timestamp(time, F.lit(tz) if tz else F.current_timezone())
    past = F.pmod(F.unix_micros(local), F.lit(HOUR_MICROS))
    return F.timestamp_micros(F.unix_micros(time) - past)


def iso_utc(time: Column) -> Column:
    """``2016-07-01T17:00:00.000Z``, in UTC whatever the session's zone."""
    return F.date_format(
        F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    )
