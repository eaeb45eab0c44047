"""Similarity of sparse and dense vectors, leader clusters and nearest-leader assignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.operators import rounds
from gleaner.operators.bounds import MOST
from gleaner.operators.priority import first_per_key
from gleaner.operators.rounds import large_groups
from gleaner.session import ship, spread, written


def sparse_cosine(a: DataFrame, b: DataFrame, id_a: str, id_b: str, on: list[str], weight: str = "w") -> DataFrame:
    """Cosines of pairs that share a key; rows are (id, key columns on, weight). Pairs that share none are 0 and absent."""
    norm = lambda df, i, c: df.groupBy(i).agg(F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias(c))
    x, y = a.withColumnRenamed(weight, "_x"), b.withColumnRenamed(weight, "_y")
    dots = x.join(y, on).groupBy(id_a, id_b).agg(F.sum(F.col("_x") * F.col("_y")).alias("_d"))
    return dots.join(norm(a, id_a, "_na"), id_a).join(norm(b, id_b, "_nb"), id_b).select(id_a, id_b, F.coalesce(F.try_divide(F.col("_d"), F.col("_na") * F.col("_nb")), F.lit(0.0)).alias("cosine"))


def profile_cosine(items: DataFrame, profiles: DataFrame, item: str | list[str], profile: str, on: list[str], weight: str = "w", most: int = 1_000_000) -> DataFrame:
    """sparse_cosine() of many items with few profiles: the profiles' weights of a key are one array, which is spread only where an item's
    rows lie together, so the products are summed where they are made. Up to `most` weights are broadcast and items stay as they are dealt (by
    item, see session.spread: a task's memory grows with its items times the profiles); with more, rows meet by key and are dealt by item after that."""
    squares, ids = F.sum(F.col(weight) * F.col(weight)), [item] if isinstance(item, str) else item
    norm = profiles.groupBy(profile).agg(F.sqrt(squares).alias("_nb"))
    weights = profiles.join(norm, profile).groupBy(*on).agg(F.collect_list(F.struct(F.col(profile), F.col(weight).alias("_y"), "_nb")).alias("_p"))
    listed = written(weights)
    few = (listed.agg(F.sum(F.size("_p"))).first()[0] or 0) <= most
    of = items.where(" or ".join(f"`{c}` is not null" for c in ids)).select(*ids, *(c for c in on if c not in ids), F.col(weight).alias("_x"), F.sqrt(squares.over(Window.partitionBy(*ids))).alias("_na"))
    met = of.join(F.broadcast(listed), on) if few else spread(of.join(listed, on), items.count(), *ids, each=100_000)
    each = met.select(*ids, "_na", "_x", F.inline("_p")).groupBy(*ids, profile)
    dots = each.agg(F.sum(F.col("_x") * F.col("_y")).alias("_d"), F.max("_na").alias("_na"), F.max("_nb").alias("_nb"))
    return dots.select(*ids, profile, F.coalesce(F.try_divide(F.col("_d"), F.col("_na") * F.col("_nb")), F.lit(0.0)).alias("cosine"))


def self_cosine(v: DataFrame, id_: str, on: list[str], weight: str = "w") -> DataFrame:
    """Cosines of unordered pairs (a < b) of one collection."""
    a, b = v.withColumnRenamed(id_, "a"), v.withColumnRenamed(id_, "b")
    return sparse_cosine(a, b, "a", "b", on, weight).where("a < b")


def leaders(sizes: DataFrame, scores: DataFrame, group: str, id_: str, size: str, threshold: float, most: int = MOST) -> DataFrame:
    """Leader clustering per group: biggest first (of equals the larger id), each joins its best leader at threshold, ties to
    the bigger, or leads itself.

    A group of up to `most` scored pairs is one task; in larger ones an item waits for its bigger neighbours only and is settled in
    rounds (see rounds.leaders), with the same result.
    """
    order = F.struct(F.col(size).alias("s"), F.col(id_).alias("i"))
    of = lambda c: sizes.select(F.col(group).alias("group"), F.col(id_).alias(c), order.alias(f"_{c}"))
    edges = scores.where(F.col("cosine") >= threshold).select(F.col(group).alias("group"), "a", "b", "cosine")
    both = edges.select("group", F.col("a").alias("x"), F.col("b").alias("y"), "cosine").union(edges.select("group", F.col("b").alias("x"), F.col("a").alias("y"), "cosine"))
    up = both.join(of("x"), ["group", "x"]).join(of("y"), ["group", "y"]).where(F.col("_y") > F.col("_x")).groupBy("group", "x", "y", F.col("_y").alias("big")).agg(F.max("cosine").alias("score"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        near: dict = {}
        for x, y, c in zip(right["x"], right["y"], right["score"]):
            near.setdefault(x, {})[y] = c
        order = left.sort_values(["size", "id"], ascending=[False, False])
        chosen, rows = {}, []
        for n, x in enumerate(order["id"]):
            best = max((y for y in near.get(x, {}) if y in chosen), key=lambda y: (near[x][y], -chosen[y]), default=x)
            if best == x:
                chosen[x] = n
            rows.append((left["group"].iloc[0], x, best))
        return pd.DataFrame(rows, columns=["group", "id", "leader"])

    ship(sizes.sparkSession)
    items = sizes.select(F.col(group).alias("group"), F.col(id_).alias("id"), F.col(size).alias("size"))
    kinds = dict(sizes.dtypes)
    schema = f"group {kinds[group]}, id {kinds[id_]}, leader {kinds[id_]}"
    up = written(up)
    large = large_groups(up, "group", most)
    few = lambda df: df if large is None else df.join(large, "group", "left_anti")
    out = few(items).groupBy("group").cogroup(few(up.select("group", "x", "y", "score")).groupBy("group")).applyInPandas(run, schema)
    if large is not None:
        edges = up.join(large, "group", "left_semi").select("group", "x", "y", F.lit("near").alias("kind"), F.lit("").alias("rule"), "score", "big")
        out = out.unionByName(rounds.leaders(items.join(large, "group", "left_semi").withColumn("leads", F.lit(False)), written(edges), threshold, threshold).select("group", "id", "leader"))
    return out.toDF(group, id_, "leader")


def assigned(scores: DataFrame, item: str, leader: str, size: str, threshold: float) -> DataFrame:
    """The nearest leader at threshold or more for each item; ties to the bigger, then the smaller id."""
    return first_per_key(scores.where(F.col("cosine") >= threshold), [item], [-F.round("cosine", 12), -F.col(size), F.col(leader)])


def dense_cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b))), F.lit(0.0))


def half_precision(v: str):
    """Vectors rounded through 16-bit floats."""

    @F.pandas_udf("array<float>")
    def rounded(x: pd.Series) -> pd.Series:
        return x.map(lambda a: None if a is None else np.asarray(a, np.float16).astype(np.float32))

    return rounded(F.col(v))


def covariance(df: DataFrame, vector: str, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, covariance (divided by n) and n: each task sums its outer products, and only the sums of size x size meet."""

    def sums(batches):
        total, outer, n = np.zeros(size), np.zeros((size, size)), 0
        for pdf in batches:
            x = np.stack(pdf[vector].to_numpy()).astype(float)
            total, outer, n = total + x.sum(axis=0), outer + x.T @ x, n + len(x)
        if n:
            yield pd.DataFrame({"n": [n], "total": [total], "outer": [outer.ravel()]})

    parts = df.where(F.col(vector).isNotNull()).select(vector).mapInPandas(sums, "n long, total array<double>, outer array<double>")
    add = lambda c, k: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get(F.col(c), i))
    long = parts.select(F.col("n"), F.posexplode(F.concat("total", add("outer", size * size))).alias("i", "v"))
    rows = {r["i"]: r["v"] for r in long.groupBy("i").agg(F.sum("v").alias("v")).collect()}
    n = parts.agg(F.sum("n")).first()[0] or 0
    flat = np.array([rows[i] for i in range(size + size * size)]) if n else np.zeros(size + size * size)
    mean = flat[:size] / max(n, 1)
    return mean, flat[size:].reshape(size, size) / max(n, 1) - np.outer(mean, mean), n


def projected(df: DataFrame, vector: str, size: int, k: int, into: str = "projected") -> DataFrame:
    """df with its vectors on the k strongest principal axes (strongest last; each axis' largest part is positive); null stays null."""
    mean, cov, _ = covariance(df, vector, size)
    axes = np.linalg.eigh(cov)[1][:, -k:]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        there = x.notna()
        onto = iter((np.stack(x[there].to_numpy()).astype(float) - mean) @ axes if there.any() else ())
        return pd.Series([next(onto) if t else None for t in there], dtype=object)

    return df.withColumn(into, project(F.col(vector)))
