"""Local wall-clock text, UTC instants and calendar days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the source writes local time, and where it is local.
LOCAL_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
DEFAULT_ZONE = "America/Chicago"


def parse_local(text: Column) -> Column:
    """Wall-clock text to a timestamp in the session zone, null if malformed."""
    return F.try_to_timestamp(text, F.lit(LOCAL_PATTERN))


def local_to_utc(wall_clock: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.to_utc_timestamp(wall_clock, zone)


def is_morning(instant: Column, zone: str | None = None) -> Column:
    """Hour before noon: of the stored UTC time, or of the time in ``zone``."""
    shown = F.from_utc_timestamp(instant, zone) if zone else instant
    return F.hour(shown) < F.lit(12)


def utc_day(instant: Column) -> Column:
    return F.to_date(instant)


def local_day(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def local_day_start(day: Column, zone: str = DEFAULT_ZONE) -> Column:
    """The UTC instant at which a local calendar day begins."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def local_day_end(day: Column, zone: str = DEFAULT_ZONE, closed: bool = False) -> Column:
    """The next day's start, or 23:59:59 of the day itself if ``closed``."""
    if closed:
        last = day.cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(23), F.lit(59), F.lit(59)
        )
        return F.to_utc_timestamp(last, zone)
    return local_day_start(F.date_add(day, 1), zone)
