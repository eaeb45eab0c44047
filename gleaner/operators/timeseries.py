"""Daily series: grids, bounded forward fill, running sums, moves and observations before a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def filled(series: DataFrame, keys: list[str], day: str, value: str, first: str, last: str, hold: int) -> DataFrame:
    """A row per key and day from first to last; a day without value takes the last one of up to hold days before.

    Keys without any value in the range or the hold before it are left out; days that stay empty are null.
    """
    grid_start = F.date_sub(F.lit(first).cast("date"), hold)
    seen = series.where((F.col(day) >= grid_start) & (F.col(day) <= F.lit(last).cast("date")))
    days = F.explode(F.sequence(grid_start, F.lit(last).cast("date"))).alias(day)
    grid = seen.select(*keys).distinct().select(*keys, days).join(seen, [*keys, day], "left")
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-hold, 0)
    out = grid.withColumn(value, F.last(value, ignorenulls=True).over(w)).where(F.col(day) >= F.lit(first).cast("date"))
    return out.withColumn("_n", F.count(value).over(Window.partitionBy(*keys))).where("_n > 0").drop("_n")


def running(df: DataFrame, keys: list[str], order: list[str], delta: str, into: str) -> DataFrame:
    """The running sum that decodes deltas."""
    return df.withColumn(into, F.sum(delta).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def sparkline(series: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """The least value of each day, in order, as a comma-joined line; empty days as nothing between commas."""
    per = series.groupBy(*keys, day).agg(F.min(value).alias("_v"))
    points = F.array_sort(F.collect_list(F.struct(day, F.coalesce(F.col("_v").cast("string"), F.lit("")).alias("v"))))
    return per.groupBy(*keys).agg(F.array_join(F.transform(points, lambda p: p["v"]), ",").alias("line"))


def moves(series: DataFrame, card: str, printing: str, day: str, value: str, start: str, end: str) -> DataFrame:
    """Per card: the cheapest price at start and at end over its printings priced at both ends, and the change."""
    at = lambda d: F.min(F.when(F.col(day) == F.lit(d).cast("date"), F.col(value)))
    both = series.where(F.col(day).isin(*(F.lit(x).cast("date") for x in (start, end)))).groupBy(card, printing).agg(at(start).alias("a"), at(end).alias("b")).where("a is not null and b is not null")
    return both.groupBy(card).agg(F.min("a").alias("before"), F.min("b").alias("now"), F.min_by(printing, F.struct("b", printing)).alias("shown")).withColumn("change", F.col("now") - F.col("before"))


def notable(before: Column, now: Column, low: int, high: int, change: int) -> Column:
    """The smaller price at least low, the larger at least high, the change at least change."""
    return (F.least(before, now) >= low) & (F.greatest(before, now) >= high) & (F.abs(now - before) >= change)


def consecutive(days: DataFrame, day: str, k: int) -> DataFrame:
    """The last k pairs of neighbouring distinct days."""
    first = days.select(day).distinct().orderBy(F.desc(day)).limit(k + 1)
    return first.withColumn("previous", F.lag(day).over(Window.orderBy(day))).where("previous is not null")


def observed_by(series: DataFrame, keys: list[str], day: str, value: str, at: str) -> DataFrame:
    """The last value of each key at or before a day."""
    return series.where(F.col(day) <= F.lit(at).cast("date")).groupBy(*keys).agg(F.max_by(value, day).alias(value), F.max(day).alias(day))


def changes(series: DataFrame, keys: list[str], day: str, value: str, now: str, before: str) -> DataFrame:
    """Keys whose value of day now differs from the last one by day before: change is changed, new or gone."""
    a = observed_by(series, keys, day, value, before).select(*keys, F.col(value).alias("old"))
    b = series.where(F.col(day) == F.lit(now).cast("date")).groupBy(*keys).agg(F.min(value).alias("new"))
    kind = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone").when(F.col("old") != F.col("new"), "changed")
    return a.join(b, keys, "full").withColumn("change", kind).where("change is not null")
