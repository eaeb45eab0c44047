"""Matching joins: nearest in a range, most overlap, shared keys, containment of names and greedy pairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.operators.bounds import MOST
from gleaner.operators.priority import first_per_key, top_per_group
from gleaner.operators.rounds import greedy, large_groups
from gleaner.session import ship, written


def nearest(left: DataFrame, right: DataFrame, on: list[str], key: str, day: str, other: str, before: int, after: int, order: list[Column]) -> DataFrame:
    """For each row of left (unique key): the row of right, equal in on, whose date other lies from day - before to
    day + after and is nearest; ties by order, whose columns are of right.

    Of right rows equal in on and date only the first in order can be chosen, so the others are left out before anything is joined: a row
    of left meets one row a day of its range, however many fall on a day.

    The range is an equality on buckets of its own width plus a filter: each right row is placed in its bucket and the
    left row looks in the buckets that its range touches, so no pair outside of them is formed.
    """
    width = before + after + 1
    bucket = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / width)
    spots = F.sequence(bucket(F.date_sub(F.col(day), before)), bucket(F.date_add(F.col(day), after)))
    a = left.withColumn("_b", F.explode(spots))
    b = first_per_key(right, [*on, other], order).withColumn("_b", bucket(F.col(other)))
    gap = F.datediff(F.col(other), F.col(day))
    pairs = a.join(b, [*on, "_b"]).where(gap.between(-before, after)).withColumn("gap", F.abs(gap)).drop("_b")
    return first_per_key(pairs, [key], [F.col("gap"), *order])


def most_overlap(a: DataFrame, b: DataFrame, element: str, key_a: str, key_b: str, within: list[str]) -> DataFrame:
    """For each group of a the group of b (equal in within) that shares most elements, at least half of b's; ties by key.

    a and b have a row per group and element.
    """
    size = b.groupBy(key_b).agg(F.count_distinct(element).alias("size"))
    shared = a.select(key_a, element, *within).distinct().join(b.select(key_b, element, *within).distinct(), [element, *within])
    counts = shared.groupBy(key_a, key_b).agg(F.count(F.lit(1)).alias("shared")).join(size, key_b).where("2 * shared >= size")
    return first_per_key(counts, [key_a], [-F.col("shared"), F.col(key_b)])


def shared_key(a: DataFrame, b: DataFrame, keys_a: str, keys_b: str, id_a: str, id_b: str) -> DataFrame:
    """Distinct pairs whose key arrays intersect: an equality join on the exploded keys."""
    x, y = a.select(id_a, F.explode(keys_a).alias("_k")), b.select(id_b, F.explode(keys_b).alias("_k"))
    return x.join(y, "_k").select(id_a, id_b).distinct()


def prefix_pairs(a: DataFrame, b: DataFrame, name_a: str, name_b: str, least: int) -> DataFrame:
    """Pairs of which one name starts with the other, both longer than least: equal on the first least + 1 letters first."""
    head = lambda c: F.substring(c, 1, least + 1)
    x = a.where(F.length(name_a) > least).withColumn("_h", head(name_a))
    y = b.where(F.length(name_b) > least).withColumn("_h", head(name_b))
    return x.join(y, "_h").where(F.col(name_a).startswith(F.col(name_b)) | F.col(name_b).startswith(F.col(name_a))).drop("_h")


def confident(candidates: DataFrame, key: str, score: str, value: str, least: float, times: float) -> DataFrame:
    """The best candidate per key if it scores least and times the runner-up; otherwise nothing."""
    w = Window.partitionBy(key).orderBy("_r")
    x = top_per_group(candidates, [key], [F.desc(score), F.col(value)], 2, "_r").withColumn("_next", F.lead(score).over(w))
    return x.where((F.col("_r") == 1) & (F.col(score) >= least) & (F.col("_next").isNull() | (F.col(score) >= times * F.col("_next")))).select(key, value, score)


def greedy_pairs(scores: DataFrame, group: str, a: str, b: str, score: str, most: int = MOST) -> DataFrame:
    """One-to-one pairs taken in order of score (desc), then a, then b, within each group; of rows that repeat a pair the
    best scored. Null scores come last.

    A group of up to `most` pairs is one task; larger ones are settled in rounds of locally best pairs (see rounds.greedy), with the
    same result.
    """
    columns = scores.columns
    once = scores.groupBy(group, a, b).agg(F.max_by(F.struct(*columns), F.coalesce(score, F.lit(float("-inf")))).alias("_r")).select("_r.*")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([score, a, b], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        used_a, used_b, rows = set(), set(), []
        for i, (x, y) in enumerate(zip(pdf[a], pdf[b])):
            if x not in used_a and y not in used_b:
                used_a.add(x), used_b.add(y), rows.append(i)
        return pdf.iloc[rows]

    ship(scores.sparkSession)
    large = large_groups(once, group, most)
    if large is None:
        return once.groupBy(group).applyInPandas(run, scores.schema)
    small = once.join(large, group, "left_anti").select(columns).groupBy(group).applyInPandas(run, scores.schema)
    return small.unionByName(greedy(written(once.join(large, group, "left_semi").select(columns)), [group], a, b, score))


def jaccard_pairs(a: DataFrame, b: DataFrame, id_a: str, id_b: str, tokens: str, least: float, on: list[str] | None = None) -> DataFrame:
    """Pairs with the Jaccard similarity of their token arrays, of least or more (above 0).

    Two such sets of n tokens share one among the n - ceil(least * n) + 1 rarest of each, so only those are joined on: a
    frequent word brings no pairs together unless a set has hardly any other. Each pair is then held on its full sets.
    """
    on = on or []
    sets = lambda df, i: df.select(F.col(i), *on, F.array_distinct(tokens).alias("_s")).where(F.size("_s") > 0)
    x, y = sets(a, id_a), sets(b, id_b)
    each = lambda df, i: df.select(i, *on, F.explode("_s").alias("_t"), F.size("_s").alias("_n"))
    spread = each(x, id_a).select("_t").union(each(y, id_b).select("_t")).groupBy("_t").agg(F.count(F.lit(1)).alias("_f"))

    def rare(df: DataFrame, i: str) -> DataFrame:
        ordered = each(df, i).join(spread, "_t").groupBy(i, *on, "_n").agg(F.array_sort(F.collect_list(F.struct("_f", "_t"))).alias("_o"))
        first = F.col("_n") - F.ceil(F.col("_n") * least - 1e-9).cast("int") + 1
        return ordered.select(i, *on, F.explode(F.slice("_o", 1, first)).alias("_x")).select(i, *on, F.col("_x._t").alias("_t"))

    pairs = rare(x, id_a).join(rare(y, id_b), [*on, "_t"]).select(*on, id_a, id_b).distinct()
    held = pairs.join(x.select(id_a, *on, F.col("_s").alias("_a")), [id_a, *on]).join(y.select(id_b, *on, F.col("_s").alias("_b")), [id_b, *on])
    both = F.size(F.array_intersect("_a", "_b"))
    out = held.withColumn("similarity", both / (F.size("_a") + F.size("_b") - both)).where(F.col("similarity") >= least)
    return out.select(*on, id_a, id_b, "similarity")
