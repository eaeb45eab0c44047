"""First-writer-wins merges and arg-min aggregates with total orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in order, by an aggregate that combines before the shuffle (no sort of groups)."""
    rest = [c for c in df.columns if c not in keys]
    ranked = df.select(*keys, F.struct(*(c.alias(f"_{i}") for i, c in enumerate(order)), *(F.col(c) for c in rest)).alias("_row"))
    rank = F.struct(*(F.col(f"_row._{i}") for i in range(len(order))))
    return ranked.groupBy(*keys).agg(F.min_by("_row", rank).alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def merged(sources: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """One row per key from the first source that has it, in order within a source; column `source` has its number."""
    tagged = [df.withColumn("source", F.lit(i)) for i, df in enumerate(sources)]
    everything = reduce(lambda a, b: a.unionByName(b), tagged)
    return first_per_key(everything, keys, [F.col("source"), *(F.col(c) for c in order)])


def mode_first_seen(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value per key; of equals the one seen first. Columns: keys, value, n."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_seen"))
    return counts.groupBy(*keys).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), "_seen")).alias("_m")).select(*keys, f"_m.{value}", "_m.n")


def unambiguous(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs once."""
    return df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key))).where("_n = 1").drop("_n")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank; Spark keeps k rows a group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
