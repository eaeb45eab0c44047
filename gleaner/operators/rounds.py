"""Passes in order, settled in rounds: an item waits only for the bigger items that can decide about it.

Each round is one join and two aggregates over the items that are still open, written as a table in the shared folder; there are
as many rounds as the longest chain of items that wait for each other. The result is that of the plain pass, biggest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.session import written


def large_groups(rows: DataFrame, group: str, most: int) -> DataFrame | None:
    """The groups with more than `most` rows, None if there are none. Smaller ones fit a task of their own."""
    found = written(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(group))
    return None if found.isEmpty() else found


def leaders(items: DataFrame, edges: DataFrame, threshold: float, sticky: float) -> DataFrame:
    """(group, id, leader, how): how is leads, joined, kept or forced.

    items: group, id, and leads (true for those that lead from the start). edges: group, x, y, kind, rule, score, big, with y bigger than x or
    leading from the start, and big a value that orders the y, the biggest last. Kinds: near (a score of threshold or more), stay (the leader that x had), apart (x may
    not be in y's group), always (rule: x goes to y's group if it may). First the groups of always, by rule and then by the biggest y; then stay at
    sticky; then the near leader with the highest score, of equals the biggest; else x leads.
    """
    first = items.where("leads").select("group", "id", F.col("id").alias("leader"), F.lit("leads").alias("how"))
    lone = items.where("not leads").join(edges.select("group", F.col("x").alias("id")).distinct(), ["group", "id"], "left_anti")
    first = written(first.unionByName(lone.select("group", "id", F.col("id").alias("leader"), F.lit("leads").alias("how"))))
    done, news = [first], first
    left = edges.withColumn("ly", F.lit(None).cast(edges.schema["y"].dataType))
    while True:
        told = news.select("group", F.col("id").alias("y"), F.col("leader").alias("_l"))
        left = left.join(told, ["group", "y"], "left").withColumn("ly", F.coalesce("ly", "_l")).drop("_l")
        state = left.groupBy("group", "x").agg(F.count_if(F.col("ly").isNull()).alias("_open"), F.collect_set(F.when(F.col("kind") == "apart", F.col("ly"))).alias("_foes"))
        left = written(left.join(state, ["group", "x"]))
        ready = left.where("_open = 0").withColumn("_fits", ~F.array_contains("_foes", F.col("ly")))
        is_ = lambda k: F.col("_fits") & (F.col("kind") == k)
        said = ready.groupBy("group", "x").agg(
            F.collect_list(F.when(is_("always"), F.struct("rule", "big", "ly"))).alias("_always"),
            F.max(F.when(is_("stay") & (F.col("score") >= sticky), F.struct("score", "ly"))).alias("_stay"),
            F.max(F.when(is_("near") & (F.col("y") == F.col("ly")) & (F.col("score") >= threshold), F.struct("score", "big", "ly"))).alias("_near"),
        )
        rule = F.array_min(F.transform("_always", lambda a: a["rule"]))
        forced = F.array_max(F.transform(F.filter("_always", lambda a: a["rule"] == rule), lambda a: F.struct(a["big"].alias("big"), a["ly"].alias("ly"))))["ly"]
        leader = F.coalesce(forced, F.col("_stay.ly"), F.col("_near.ly"), F.col("x"))
        how = F.when(forced.isNotNull(), "forced").when(F.col("_stay").isNotNull(), F.when(F.col("_stay.score") >= threshold, "joined").otherwise("kept")).when(F.col("_near").isNotNull(), "joined").otherwise("leads")
        news = written(said.select("group", F.col("x").alias("id"), leader.alias("leader"), how.alias("how")))
        if news.isEmpty():
            break
        done.append(news)
        left = left.where("_open > 0").drop("_open", "_foes")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def greedy(scores: DataFrame, keys: list[str], a: str, b: str, score: str) -> DataFrame:
    """One-to-one pairs by score (desc), then a, then b: every round takes the pairs that are the best left of both their
    ends, which are those that the plain pass would take, and drops the pairs of their ends. Scores that are null come last."""
    order = F.struct(F.coalesce(-F.col(score), F.lit(float("inf"))).alias("s"), F.col(a).alias("a"), F.col(b).alias("b"))
    left, done = scores.withColumn("_o", order), []
    while True:
        best = lambda k: left.groupBy(*keys, k).agg(F.min("_o").alias(f"_best_{k}"))  # noqa: B023, E731
        marked = left.join(best(a), [*keys, a]).join(best(b), [*keys, b])
        taken = written(marked.where((F.col("_o") == F.col(f"_best_{a}")) & (F.col("_o") == F.col(f"_best_{b}"))).drop(f"_best_{a}", f"_best_{b}"))
        if taken.isEmpty():
            break
        done.append(taken)
        left = written(left.join(taken.select(*keys, a), [*keys, a], "left_anti").join(taken.select(*keys, b), [*keys, b], "left_anti"))
    out = scores.limit(0)
    for part in done:
        out = out.unionByName(part.drop("_o"))
    return out
