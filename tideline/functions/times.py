"""Wall-clock times of one source zone as epoch numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_us(wall: Column, zone: str) -> Column:
    """DT1: microseconds since 1970 of a zone-less time read as wall time in ``zone``.

    The session time zone plays no part. A time skipped by a clock change keeps the offset before the
    change; a time that occurs twice means its first occurrence.
    """
    utc = wall if zone.upper() == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    since = utc - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("bigint")


def epoch_ms(wall: Column, zone: str) -> Column:
    """DT1 in milliseconds, cut towards zero."""
    return _whole_div(epoch_us(wall, zone), 1_000)


def epoch_ns(wall: Column, zone: str) -> Column:
    """DT1 in nanoseconds."""
    return epoch_us(wall, zone) * 1_000


def instant_ms(instant: Column) -> Column:
    """Milliseconds of a time that already carries its zone."""
    return _whole_div(F.unix_micros(instant), 1_000)


def _whole_div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))
