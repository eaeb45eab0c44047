"""Composite probabilities of drawing an item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def hit(weight: Column, total: Column, count: Column, fixed: Column, duplicates: Column) -> Column:
    """The chance that a sheet of count draws gives an item: 1 if fixed, by independent draws if duplicates may come,
    otherwise count draws without one, at most 1."""
    p = F.try_divide(weight, total)
    return F.coalesce(F.when(fixed, F.lit(1.0)).when(duplicates, 1 - F.pow(1 - p, count)).otherwise(F.least(F.lit(1.0), p * count)), F.lit(0.0))


def at_least_once(hits: DataFrame, keys: list[str], p: str) -> DataFrame:
    """1 - the product of (1 - p) over a key's rows; exact where p is 1."""
    miss = F.aggregate(F.sort_array(F.collect_list(p)), F.lit(1.0), lambda acc, x: acc * (1 - x))
    return hits.groupBy(*keys).agg((1 - miss).alias("chance"))


def over_layouts(chances: DataFrame, layouts: DataFrame, product: str, layout: str, item: str, weight: str) -> DataFrame:
    """Per product and item: the chances of the product's layouts, weighted by how often each is packed."""
    total = layouts.groupBy(product).agg(F.sum(weight).alias("_t"))
    x = chances.join(layouts, [product, layout]).join(total, product)
    return x.groupBy(product, item).agg(F.try_divide(F.sum(F.col("chance") * F.col(weight)), F.max("_t")).alias("chance"))
