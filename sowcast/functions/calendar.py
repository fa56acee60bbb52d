"""Dates: the as-of day, weeks, and days projected on the as-of year."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = date | str | Column | None


def as_of_date(as_of: AsOf = None) -> Column:
    """The day a job is run for. ``None`` means today in the session time zone."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)


def service_date(text: Column | str) -> Column:
    """A date as services write it, ``2026-02-28`` or ``2/28/2026``; null if neither."""
    text = F.col(text) if isinstance(text, str) else text
    # what is tried in vain costs several times as much as what can be read
    slashed = F.when(F.contains(text, F.lit("/")), F.try_to_timestamp(text, F.lit("M/d/yyyy")))
    dashed = F.when(~F.contains(text, F.lit("/")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))
    return F.coalesce(slashed, dashed).cast("date")


def week_start(day: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def nth_day_of_year(n: Column, as_of: AsOf = None) -> Column:
    """The n-th day counted from 1 January of the as-of year (1 = that day).

    Day 366 of a leap year therefore lands on 1 January after a common year.
    """
    new_year = F.make_date(F.year(as_of_date(as_of)), F.lit(1), F.lit(1))
    return F.date_add(new_year, (n - 1).cast("int"))


def project_to_year(day: Column | str, as_of: AsOf = None) -> Column:
    """The same day-of-year in the as-of year."""
    return nth_day_of_year(F.dayofyear(day), as_of)


def short_day(day: Column | str) -> Column:
    """``Feb 28``"""
    return F.date_format(day, "MMM dd")


def month_and_day(day: Column | str) -> Column:
    """``February 28``"""
    return F.date_format(day, "MMMM dd")


def weekday_name(day: Column | str) -> Column:
    """``Saturday``"""
    return F.date_format(day, "EEEE")


def long_day(day: Column | str) -> Column:
    """``February 28, 2026``"""
    return F.date_format(day, "MMMM dd, yyyy")
