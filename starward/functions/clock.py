"""Dates and times.  No function reads the clock: jobs pass the day in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def month_id(day: Column) -> Column:
    """``yyyymm``: the first six digits of the date number."""
    return F.date_format(day, "yyyyMM").cast("int")


def full_date_name(day: Column) -> Column:
    """``Saturday, 01-01-2005``."""
    return F.date_format(day, "EEEE, MM-dd-yyyy")


def month_name(day: Column) -> Column:
    """``January 2005``."""
    return F.date_format(day, "MMMM yyyy")


def year_name(day: Column) -> Column:
    return F.year(day).cast("string")


def visit_time(day: Column, time: Column) -> Column:
    """A date plus an ``H:mm`` text."""
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), time)
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd H:mm"))


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries between two ``HH:mm:ss`` texts, without sign.

    Both texts are read on one day, so a shift over midnight counts the long way round: 21 to 09
    gives 12, which is right only because the two ways are equally long.
    """
    def hour(text: Column) -> Column:
        return F.substring_index(text, ":", 1).cast("int")

    return F.abs(hour(end) - hour(start))


def long_date(ts: Column) -> Column:
    """``Sunday, March 10, 2024``."""
    return F.date_format(ts, "EEEE, MMMM d, yyyy")


def short_time(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")
