"""Differences: between lists, between runs, and what is new or due since."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def list_diff(now: DataFrame, base: DataFrame, keys: list[str], quantity: str) -> DataFrame:
    """added and removed copies of each key between two lists (rows unique in keys)."""
    a, b = now.withColumnRenamed(quantity, "_a"), base.withColumnRenamed(quantity, "_b")
    gap = F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))
    return a.join(b, keys, "full").select(*keys, F.greatest(gap, F.lit(0)).alias("added"), F.greatest(-gap, F.lit(0)).alias("removed")).where("added + removed > 0")


def fingerprint(*columns: str) -> Column:
    """A digest of the columns' canonical JSON; columns are sorted by name, so their order does not matter."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def changed(new: DataFrame, state: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows of new that are not in state with the same digest: what has to be written."""
    return new.join(state.select(key, digest), [key, digest], "left_anti")


def manifest(new: DataFrame, old: DataFrame, key: str, digest: str) -> DataFrame:
    """Every key with its newest digest, and its status: new, changed, same or carried over."""
    a, b = new.select(key, F.col(digest).alias("_a")), old.select(key, F.col(digest).alias("_b"))
    status = F.when(F.col("_a").isNull(), "carried").when(F.col("_b").isNull(), "new").when(F.col("_a") == F.col("_b"), "same").otherwise("changed")
    return a.join(b, key, "full").select(key, F.coalesce("_a", "_b").alias(digest), status.alias("status"))


def new_since(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    return now.join(before.select(key), key, "left_anti")


def rising(now: DataFrame, before: DataFrame, key: str, count: str, least: int, rise: int, percent: int) -> DataFrame:
    """Keys of at least `least` whose count rose by rise and percent since the run before, with the change per cent."""
    x = now.join(before.select(key, F.col(count).alias("before")), key)
    up = F.col(count) - F.col("before")
    return x.where((F.col(count) >= least) & (up >= rise) & (100 * up >= percent * F.col("before"))).select(key, count, "before", up.alias("rise"), F.round(100.0 * up / F.nullif(F.col("before"), F.lit(0)), 1).alias("percent"))


def due(items: DataFrame, state: DataFrame, key: str, reasons: dict[str, Column]) -> DataFrame:
    """Items with at least one reason to be done again, reasons in the given order, comma-joined."""
    x = items.join(state, key, "left")
    told = F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in reasons.items())), lambda r: r.isNotNull())
    return x.withColumn("reasons", F.array_join(told, ",")).where("reasons <> ''")
