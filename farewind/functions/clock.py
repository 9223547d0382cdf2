"""Epoch seconds, calendar days and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farewind.functions._columns import as_column


def epoch_timestamp(seconds: Column | str) -> Column:
    """Epoch seconds to an instant."""
    return F.timestamp_seconds(as_column(seconds))


def epoch_text(seconds: Column | str, utc_offset_hours: int = 0) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` at a fixed offset from UTC.

    Computed on a zone-less timestamp, so the text does not depend on the session time zone.
    """
    shifted = as_column(seconds).cast("bigint") + F.lit(utc_offset_hours * 3600)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=shifted.cast("decimal(18,6)"))).cast("string")


def days_after(base: Column | str, days: Column | int = 0) -> Column:
    """The date ``days`` after ``base``."""
    return F.date_add(as_column(base), days)
