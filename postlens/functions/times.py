"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column, fmt: str | None = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp of a string; null when it does not parse. `fmt=None` takes ISO-8601."""
    if fmt is None:
        return F.try_to_timestamp(text)
    return F.try_to_timestamp(text, F.lit(fmt))


def epoch_string(seconds: Column) -> Column:
    """Epoch seconds (missing = 0) as `yyyy-MM-dd HH:mm:ss` in UTC.

    Built on a zone-free timestamp, so the session zone does not matter.
    """
    whole = F.floor(F.coalesce(seconds.cast("double"), F.lit(0.0))).cast("long")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + F.make_dt_interval(secs=whole.cast("decimal(18,6)"))).cast("string")


def day_string(ts: Column) -> Column:
    """Start of the day as text, e.g. `2024-01-31 00:00:00`."""
    return F.date_trunc("day", ts).cast("string")


def elapsed_ms(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1000.0)
