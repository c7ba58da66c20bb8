"""Dates from epoch numbers and strings, independent of the session time zone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnitudes above which a number is milliseconds or seconds.
MILLIS_ABOVE = 1e12
SECONDS_ABOVE = 1e9

DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd")


def epoch_to_ntz(x: Column, zone: str = "UTC") -> Column:
    """Local wall time in ``zone`` of an epoch number in ms or s; NULL for smaller numbers."""
    number = x.cast("double")
    seconds = F.when(number > MILLIS_ABOVE, number / 1000).when(number > SECONDS_ABOVE, number)
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    utc = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def text_to_ntz(x: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses; NULL if none does. Formats without separators need their exact length."""
    parsed = []
    for f in formats:
        text = x if not f.isalpha() else F.when(x.rlike(f"^[0-9]{{{len(f)}}}$"), x)
        parsed.append(F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz"))
    return F.coalesce(*parsed)


def any_to_ntz(x: Column, zone: str = "UTC", formats: Sequence[str] = DATE_FORMATS) -> Column:
    """An epoch number written as text, or a date in one of ``formats``."""
    number = F.when(x.rlike(r"^[0-9]{9,}$"), x).try_cast("double")
    return F.coalesce(epoch_to_ntz(number, zone), text_to_ntz(x, formats))


def strict_date(text: str) -> Column:
    """A literal date; anything but YYYY-MM-DD is refused before a job starts."""
    try:
        return F.lit(datetime.strptime(text, "%Y-%m-%d").date())
    except ValueError as bad:
        raise ValueError(f"dates must be YYYY-MM-DD, got {text!r}") from bad
