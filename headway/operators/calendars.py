"""Date spines and interval expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_days(df: DataFrame, start: Column | str, end: Column | str, out: str = "date", closed: bool = True) -> DataFrame:
    """One row per day of [start, end], or [start, end) when not closed.

    Reversed or NULL intervals give no rows (``sequence`` would raise on them).
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    last = end if closed else F.date_sub(end, 1)
    days = F.when(start <= last, F.sequence(start, last, F.expr("interval 1 day")))
    return df.withColumn(out, F.explode(days))


def in_ranges(days: DataFrame, day: str, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct days of ``days`` that fall in some [start, end).

    Ranges are expanded to days and matched by equality, so there is no nested loop;
    both sides are reduced to distinct values first.
    """
    spans = ranges.select(start, end).distinct()
    covered = explode_days(spans, start, end, "_day", closed=False).select("_day").distinct()
    return days.select(day).distinct().join(covered, F.col(day) == F.col("_day"), "left_semi")
