"""Dates, clock texts and durations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.text import _col

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_STAMP_FORMAT = "yyyyMMdd'T'HHmmss"


def gtfs_seconds(c: Column | str) -> Column:
    """'25:10:05' to 90605. Service clocks pass midnight, so this is never a timestamp.

    Cut by position of the colons, which stays on bytes; splitting would build an array of
    strings per row of the largest table.
    """
    c = _col(c)
    upto = [F.substring_index(c, ":", n) for n in (1, 2, 3)]
    hours, minutes, seconds = (F.substring_index(part, ":", -1).try_cast("int") for part in upto)
    colons = F.length(c) - F.length(F.replace(c, F.lit(":"), F.lit("")))
    return F.when(colons >= 2, hours * 3600 + minutes * 60 + seconds)


def hour_band(c: Column | str) -> tuple[Column, Column]:
    """'7H-8H' to (7, 8)."""
    return (
        F.regexp_extract(_col(c), r"^(\d+)H", 1).try_cast("int"),
        F.regexp_extract(_col(c), r"-(\d+)H", 1).try_cast("int"),
    )


def compact_date(c: Column | str) -> Column:
    """20250131, number or text, to a date."""
    return F.try_to_date(_col(c).cast("string"), "yyyyMMdd")


def prefix_date(c: Column | str) -> Column:
    """The date in the first ten characters."""
    return F.substring(_col(c), 1, 10).try_cast("date")


def stamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp, NULL when it does not parse; without a format, ISO 8601."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def moment(at: datetime) -> Column:
    """A fixed time of the session's zone; a plain literal would be read in the driver's own zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, each cut to its second first."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def iso_weekday(c: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(_col(c)) + 1


def is_weekend(c: Column | str) -> Column:
    return F.weekday(_col(c)) >= 5


def day_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def iso_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def iso_stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")


def day_category(day: Column, is_holiday: Column, in_break: Column) -> Column:
    """Passenger-count day type from weekday, public holiday and school break."""
    weekday = F.weekday(day)
    return (
        F.when((weekday == 6) | is_holiday, F.lit("DIJFP"))
        .when(weekday == 5, F.when(in_break, F.lit("SAVS")).otherwise(F.lit("SAHV")))
        .otherwise(F.when(in_break, F.lit("JOVS")).otherwise(F.lit("JOHV")))
    )


def fallback_day_category(day: Column) -> Column:
    """Day type used for dates the calendar does not cover."""
    return F.when(is_weekend(day), F.lit("SAHV")).otherwise(F.lit("JOHV"))
