"""Trailing windows that end at a given time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def at(now: str) -> Column:
    return F.lit(now).cast("timestamp")


def within(ts: Column, now: str, days: int, until: int = 0) -> Column:
    """now - days <= ts, up to the end of today; with until, before now - until days."""
    lower = ts >= at(now) - F.make_interval(days=F.lit(days))
    upper = ts < at(now) - F.make_interval(days=F.lit(until)) if until else F.to_date(ts) <= F.to_date(at(now))
    return lower & upper


def since(ts: Column, now: str, days: int) -> Column:
    """now - days <= ts, without an upper end."""
    return ts >= at(now) - F.make_interval(days=F.lit(days))


def trailing(df: DataFrame, ts: str, now: str, days: tuple[int, ...] = (7, 14, 30)) -> DataFrame:
    """A row of df for each window of days (column `window`) that it falls in: one scan for all windows."""
    inside = F.filter(F.array(*(F.when(within(F.col(ts), now, n), n) for n in days)), lambda x: x.isNotNull())
    return df.where(within(F.col(ts), now, max(days))).select("*", F.explode(inside).alias("window"))


def kept_by_latest(rows: DataFrame, key: str, ts: str, now: str, days: int) -> DataFrame:
    """All rows of each key whose latest row lies within the days."""
    alive = rows.groupBy(key).agg(F.max(ts).alias("_latest")).where(since(F.col("_latest"), now, days)).select(key)
    return rows.join(alive, key, "left_semi")
