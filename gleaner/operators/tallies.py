"""Tallies of decks and copies per card, consensus lists, profiles and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.functions import numbers


def tally(lines: DataFrame, groups: list[str], decks: DataFrame | None = None) -> DataFrame:
    """Per group and card: decks that play it, copies, share of the group's decks and average copies (one digit).

    lines has one row per deck, board and card; decks gives each group's decks (those of lines by default).
    """
    of = (decks if decks is not None else lines).groupBy(*groups).agg(F.count_distinct("deck_id").alias("of_decks"))
    per = lines.groupBy(*groups, "slug").agg(F.count_distinct("deck_id").alias("decks"), F.sum("qty").alias("copies"))
    out = per.join(of, groups)
    return out.select(*groups, "slug", "decks", "copies", "of_decks", numbers.share(F.col("decks"), F.col("of_decks")).alias("share"), F.round(F.col("copies") / F.col("decks"), 1).alias("avg_copies"))


def floor(decks: Column, of_decks: Column, least: int = 2, percent: int = 1) -> Column:
    """At least so many decks and so many percent of all, judged on exact counts."""
    return (decks >= least) & (100 * decks >= percent * of_decks)


def consensus(lines: DataFrame, groups: list[str]) -> DataFrame:
    """Per group and board: cards in at least half of the lists, with average copies rounded half up, at least one."""
    of = lines.groupBy(*groups).agg(F.count_distinct("deck_id").alias("of_decks"))
    per = lines.groupBy(*groups, "board", "slug").agg(F.count(F.lit(1)).alias("decks"), F.sum("qty").alias("copies"))
    kept = per.join(of, groups).where("2 * decks >= of_decks")
    return kept.select(*groups, "board", "slug", "decks", F.greatest(F.lit(1), F.floor(F.col("copies") / F.col("decks") + 0.5)).cast("bigint").alias("quantity"))


def hand(lines: DataFrame, groups: list[str], k: int = 5) -> DataFrame:
    """The k cards of each group with the most copies; ties by slug."""
    from gleaner.operators.priority import top_per_group

    total = lines.groupBy(*groups, "slug").agg(F.sum("qty").alias("copies"))
    return top_per_group(total, groups, [F.desc("copies"), F.col("slug")], k)


def profile(lines: DataFrame, groups: list[str], cap: int = 4) -> DataFrame:
    """Average copies per card over all decks of the group, each deck's copies capped after its lines are summed."""
    vector = lines.groupBy(*groups, "deck_id", "slug").agg(F.least(F.sum("qty"), F.lit(cap)).alias("w"))
    of = vector.groupBy(*groups).agg(F.count_distinct("deck_id").alias("decks"))
    return vector.groupBy(*groups, "slug").agg(F.sum("w").alias("w")).join(of, groups).select(*groups, "slug", (F.col("w") / F.col("decks")).alias("w"), "decks")


def majority(df: DataFrame, groups: list[str], member: str, element: str) -> DataFrame:
    """Elements that at least half of a group's members with any element have."""
    known = df.groupBy(*groups).agg(F.count_distinct(member).alias("known"))
    per = df.groupBy(*groups, element).agg(F.count_distinct(member).alias("n"))
    return per.join(known, groups).where("2 * n >= known").select(*groups, element, "n", "known")


def apportioned(df: DataFrame, groups: list[str], amount: str, order: str, whole: int = 1000) -> DataFrame:
    """Largest remainders: column `units` of each row, whole together per group; ties by order. Groups without mass go."""
    w = Window.partitionBy(*groups)
    total = F.sum(amount).over(w)
    x = df.withColumn("_t", total).where("_t > 0").withColumn("_x", F.col(amount) * whole / F.col("_t"))
    x = x.withColumn("_f", F.floor("_x").cast("bigint"))
    x = x.withColumn("_r", F.row_number().over(w.orderBy(F.desc(F.round(F.col("_x") - F.col("_f"), 9)), order))).withColumn("_m", whole - F.sum("_f").over(w))
    return x.withColumn("units", F.col("_f") + (F.col("_r") <= F.col("_m")).cast("bigint")).drop("_t", "_x", "_f", "_r", "_m")


def everywhere(lines: DataFrame, groups: list[str]) -> DataFrame:
    """Cards that every deck of the group plays."""
    of = lines.groupBy(*groups).agg(F.count_distinct("deck_id").alias("of_decks"))
    per = lines.groupBy(*groups, "slug").agg(F.count_distinct("deck_id").alias("decks"))
    return per.join(of, groups).where("decks = of_decks").select(*groups, "slug", "decks")
