"""Top lists, queues and samples with total orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def diversified(df: DataFrame, group: str, own: list[Column], order: list[Column], k: int) -> DataFrame:
    """The best row of each group (by own), filled up to k with the best of the rest, ranked by order.

    Only the best of each group and the k best of all are candidates, so what is ranked stays small.
    """
    w = Window.partitionBy(group).orderBy(*own)
    marked = df.withColumn("_own", F.row_number().over(w))
    best = marked.where("_own = 1").orderBy(*order).limit(k)
    fill = marked.where("_own > 1").orderBy(*order).limit(k)
    both = best.withColumn("_f", F.lit(0)).union(fill.withColumn("_f", F.lit(1))).orderBy("_f", *order).limit(k)
    return both.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")).drop("_own", "_f")


def queue(df: DataFrame, tier: Column, checked: str, k: int) -> DataFrame:
    """The next k to check: by tier, the never checked first, then the longest unchecked; ties by all columns."""
    return df.withColumn("_t", tier).orderBy("_t", F.col(checked).asc_nulls_first(), *[c for c in df.columns if c != checked]).limit(k).drop("_t")


def affordable(df: DataFrame, keys: list[str], order: list[Column], cost: str, budget: float | Column) -> DataFrame:
    """The longest prefix of each group in order whose running cost stays within budget."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("spent", F.sum(cost).over(w)).where(F.col("spent") <= budget)


def spread(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """k rows of each group evenly spread over its order, the first and last among them; all if there are no more."""
    w = Window.partitionBy(*keys)
    x = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.bround(j * (F.col("_n") - 1) / max(1, k - 1)).cast("int"))
    last = F.col("_i") == F.col("_n") - 1
    return x.where((F.col("_n") <= k) | (last if k == 1 else F.array_contains(wanted, F.col("_i")))).drop("_i", "_n")


def strided(df: DataFrame, keys: list[str], order: list[Column], step: int) -> DataFrame:
    """Every step-th row of each group, from the first."""
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).where(F.col("_i") % step == 0).drop("_i")


def round_robin(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """turn: the row's number within its group; sorting by (turn, group) takes the groups in turns."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
