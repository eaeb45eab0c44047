"""Dates and stamps; the clock is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def stamp(x: Column) -> Column:
    """A UTC stamp as the documents carry it."""
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parsed(x: Column) -> Column:
    """Stamps with up to nine fraction digits; null if malformed."""
    return F.try_to_timestamp(F.regexp_replace(x, r"(\.\d{6})\d+", "$1"))


def days_between(a: Column, b: Column) -> Column:
    """Days from a to b (dates as text), at least 1; 1 if either is no date."""
    return F.greatest(F.lit(1), F.coalesce(F.datediff(F.try_to_date(b), F.try_to_date(a)), F.lit(1)))


def months_back(now: Column, n: int) -> Column:
    """The first days of the last n months, newest first."""
    start = F.trunc(now, "month")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.add_months(start, -i))


def long_date(x: Column) -> Column:
    """'March 4, 2024' as a date; null if malformed."""
    return F.try_to_date(x, "MMMM d, yyyy")


def stale(at: Column, now: Column, days: int) -> Column:
    """Whether something of time at is missing or older than days."""
    return at.isNull() | (at < now - F.make_interval(days=F.lit(days)))


def day_number(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))
