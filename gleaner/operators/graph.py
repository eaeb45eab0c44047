"""Graphs: components, constrained unions, roots and walks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.session import ship, written


def min_label(spark: SparkSession, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of an edge.

    A round points every node to its smallest neighbour, follows the pointers to their ends, and goes on with the edges
    between different ends only: at least half of the nodes that still have such an edge are gone after each. Rounds are tables in the
    session's shared folder, so lineage stays short and a lost executor loses nothing.
    """
    ends = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").distinct())
    out = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().withColumn("label", F.col("node"))
    left = written(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        point = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("to")))
        moved = True
        while moved:
            onward = point.select(F.col("node").alias("to"), F.col("to").alias("next"))
            far = written(point.join(onward, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
            point, moved = far.select("node", "to"), not far.where("moved").isEmpty()
        out = written(out.join(point.select(F.col("node").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label")))
        end = lambda c: point.select(F.col("node").alias(c), F.col("to").alias(f"{c}_"))  # noqa: B023, E731
        joined = left.join(end("a"), "a").join(end("b"), "b").where("a_ <> b_")
        left = written(joined.select(F.least("a_", "b_").alias("a"), F.greatest("a_", "b_").alias("b")).distinct())
    return out


def union_with_apart(edges: DataFrame, apart: DataFrame, group: str) -> DataFrame:
    """Groups of names joined by edges in order (column ord), except unions that would bring an apart pair together.

    edges: group, ord, a, b; apart: group, a, b. Result: group, name, root (the smallest name of its set). Repeated edges change
    nothing, so only the first of each counts. Plain components come first: one without an apart pair is a result as it is. Whether
    a union holds depends on the unions before it, so each other component is one task that takes its edges in order.
    """
    edges = written(edges.where("a is not null and b is not null").groupBy(group, "a", "b").agg(F.min("ord").alias("ord")))
    end = lambda c: F.struct(F.col(group).alias("g"), F.col(c).alias("n"))
    label = min_label(edges.sparkSession, edges.select(end("a").alias("x"), end("b").alias("y")), "x", "y")
    of = label.select(F.col("node.g").alias(group), F.col("node.n").alias("name"), F.col("label.n").alias("label"))
    foes = apart.select(group, "a", "b").distinct()
    at = lambda c: of.select(group, F.col("name").alias(c), F.col("label").alias(f"_{c}"))
    foes = written(foes.join(at("a"), [group, "a"]).join(at("b"), [group, "b"]).where("_a = _b").select(group, F.col("_a").alias("label"), "a", "b"))
    split = foes.select(group, "label").distinct()
    whole = of.join(split, [group, "label"], "left_anti").select(group, "name", F.col("label").alias("root"))
    torn = edges.join(at("a"), [group, "a"]).withColumnRenamed("_a", "label").join(split, [group, "label"], "left_semi")

    def run(e: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        root: dict = {}
        members: dict = {}
        foes: dict = {}
        for x, y in zip(f["a"], f["b"]):
            foes.setdefault(x, set()).add(y)
            foes.setdefault(y, set()).add(x)
        e = e.sort_values(["ord", "a", "b"])
        for x in pd.unique(e[["a", "b"]].to_numpy().ravel()):
            root[x], members[x] = x, [x]
        for x, y in zip(e["a"], e["b"]):
            p, q = root[x], root[y]
            if p == q:
                continue
            if len(members[p]) < len(members[q]):
                p, q = q, p
            if any(root.get(z) == p for m in members[q] for z in foes.get(m, ())):
                continue
            for m in members[q]:
                root[m] = p
            members[p] += members.pop(q)
        least = {p: min(m) for p, m in members.items()}
        return pd.DataFrame({group: [e[group].iloc[0]] * len(root), "name": list(root), "root": [least[p] for p in root.values()]})

    ship(edges.sparkSession)
    kind, name = dict(edges.dtypes)[group], dict(edges.dtypes)["a"]
    by = (group, "label")
    return whole.unionByName(torn.groupBy(*by).cogroup(foes.groupBy(*by)).applyInPandas(run, f"{group} {kind}, name {name}, root {name}"))


def roots(spark: SparkSession, parents: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root): the last node of each chain of parents; null if the chain runs in a circle.

    Steps double until nothing moves, or until they exceed the number of rows, which only a circle does. Every round is a
    table in the session's shared folder.
    """
    now = parents.select(F.col(node).alias("node"), F.col(parent).alias("at"))
    up = now.select(F.col("node").alias("at"), F.col("at").alias("next"))
    state = now.select("node", F.coalesce("at", "node").alias("at"))
    hop = up.select("at", F.coalesce("next", "at").alias("next"))
    for _ in range(max(1, now.count().bit_length())):
        moved = written(state.join(hop, "at", "left").select("node", F.coalesce("next", "at").alias("at"), (F.coalesce("next", "at") != F.col("at")).alias("moved")))
        state = moved.select("node", "at")
        if moved.where("moved").isEmpty():
            break
        hop = written(hop.join(hop.select(F.col("at").alias("next"), F.col("next").alias("far")), "next", "left").select("at", F.coalesce("far", "next").alias("next")))
    last = up.where("next is null").select("at", F.lit(True).alias("ends"))
    out = state.join(last, "at", "left").join(up.select("at", F.lit(True).alias("known")), "at", "left")
    return out.select("node", F.when(F.col("ends") | F.col("known").isNull(), F.col("at")).alias("root"))


def reachable(edges: DataFrame, start: DataFrame, a: str, b: str, depth: int) -> DataFrame:
    """(node, steps): nodes within depth steps of start (column node), each with its fewest steps; circles end."""
    seen = written(start.select("node").distinct().withColumn("steps", F.lit(0)))
    front = seen
    for k in range(1, depth + 1):
        front = edges.join(front.select(F.col("node").alias(a)), a).select(F.col(b).alias("node")).distinct().join(seen, "node", "left_anti").withColumn("steps", F.lit(k))
        front = written(front)
        if front.isEmpty():
            break
        seen = seen.union(front)
    return seen
