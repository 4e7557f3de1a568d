"""Local time, the receipt window of a flight day, and time texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The home time zone and the (exclusive) local bounds of a flight day.
HOME_ZONE = "America/Denver"
WINDOW_OPENS = "03:00:00"
WINDOW_CLOSES = "23:59:59"
DAYLIGHT_OFFSET_SECONDS = -6 * 3600


def local_time(instant: Column, zone: str = HOME_ZONE) -> Column:
    """Wall-clock time of an instant, cut to the millisecond, without a zone."""
    return F.date_trunc("millisecond", F.from_utc_timestamp(instant, zone)).cast("timestamp_ntz")


def flight_date(day: Column) -> Column:
    """Date of a flight day; months and days may be written without a leading zero."""
    return F.to_date(day, "yyyy-M-d")


def local_instant(date: Column, clock: str, zone: str = HOME_ZONE) -> Column:
    """The instant at which local clocks of ``zone`` show ``clock`` on ``date``."""
    wall = F.concat_ws(" ", F.date_format(date, "yyyy-MM-dd"), F.lit(clock)).cast("timestamp")
    return F.to_utc_timestamp(wall, zone)


def is_daylight_time(date: Column, zone: str = HOME_ZONE) -> Column:
    """Whether daylight-saving time holds when the flight day opens."""
    opening = local_instant(date, WINDOW_OPENS, zone)
    offset = F.unix_seconds(F.from_utc_timestamp(opening, zone)) - F.unix_seconds(opening)
    return offset == DAYLIGHT_OFFSET_SECONDS


def epoch_millis(naive: Column) -> Column:
    """Milliseconds since 1970 of a zone-less time."""
    return F.unix_millis(naive.cast("timestamp"))


def duration_text(seconds: Column) -> Column:
    """``2hrs 19mins 30secs``, every part cut towards zero."""
    hours = (seconds / 3600).cast("bigint")
    minutes = ((seconds - hours * 3600) / 60).cast("bigint")
    rest = (seconds - hours * 3600 - minutes * 60).cast("bigint")
    return F.concat(
        hours.cast("string"), F.lit("hrs "), minutes.cast("string"), F.lit("mins "),
        rest.cast("string"), F.lit("secs"),
    )


def time_text(naive: Column) -> Column:
    """``HH:MM:SS``."""
    return F.date_format(naive, "HH:mm:ss")


def date_time_text(naive: Column) -> Column:
    """``yyyy-MM-dd HH:MM:SS``."""
    return F.date_format(naive, "yyyy-MM-dd HH:mm:ss")
