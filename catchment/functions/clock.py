"""Local time, UTC time and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone of all local times.
LOCAL_ZONE = "Europe/London"

# Collection windows by ISO-like weekday (0 is Monday) and local hours.
CALENDAR_RULES = (
    ("weekday_morning", (1, 2, 3), "07:00", "10:00"),
    ("weekday_evening", (1, 2, 3), "17:00", "21:00"),
    ("weekend_morning", (5, 6), "07:00", "10:00"),
    ("weekend_evening", (4, 5, 6), "17:00", "21:00"),
)

HAS_OFFSET = r"[Tt ].*([Zz]|[+\-]\d{2}(:?\d{2})?)$"


def wall_time(text: Column) -> Column:
    """ISO text as local wall time: naive text is local already, text with an offset is converted."""
    shifted = F.from_utc_timestamp(F.to_timestamp(text), LOCAL_ZONE).cast("timestamp_ntz")
    return F.when(text.rlike(HAS_OFFSET), shifted).otherwise(F.to_timestamp_ntz(text))


def to_utc(wall: Column) -> Column:
    """Local wall time as a UTC instant (session zone UTC); the earlier reading in the repeated hour."""
    return F.to_utc_timestamp(wall.cast("timestamp"), LOCAL_ZONE)


def epoch_seconds(wall: Column) -> Column:
    """Whole seconds of a wall time on its own clock."""
    return F.unix_seconds(wall.cast("timestamp"))


def crosses_midnight(opens: Column, closes: Column) -> Column:
    return F.when((opens != "") & (closes != ""), closes <= opens)


def window_expired(window_end: Column, now: Column) -> Column:
    return F.coalesce(now >= window_end, F.lit(False))


def iso_text(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssXXX")


def wall_text(wall: Column) -> Column:
    return F.date_format(wall.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
