"""Date and duration expressions. They take and give zone-free values, so no session time zone matters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_hours(start: Column, end: Column) -> Column:
    """Whole hours from start to end, cut toward zero row by row; null when either end is missing.

    Minutes are dropped before any sum, so 71 h 15 min is 71 and -72 h 45 min is -72.
    """
    gap = end - start
    days = F.date_part(F.lit("DAY"), gap).cast("bigint")
    hours = F.date_part(F.lit("HOUR"), gap).cast("bigint")
    return days * 24 + hours


def within_day(moment: Column, day: dt.date) -> Column:
    """Rows of one day as a range on the raw column, which the Parquet scan can use to skip row groups."""
    start = F.lit(day).cast("timestamp_ntz")
    end = F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    return (moment >= start) & (moment < end)


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def file_day(day: Column) -> Column:
    """The form used in dump file names."""
    return F.date_format(day, "yyyy_MM_dd")
