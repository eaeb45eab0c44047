"""A merge plan applied to what is published: metagame tiles, event results, histories and the list of merges.

All four read the same plan (group, id, leader) and the same results that joined a leader (group, deck_id, leader). names: group, id,
name of every archetype that has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _led(df: DataFrame, plan: DataFrame, id_: str) -> DataFrame:
    """df with the leader of its archetype, itself where the plan has none; null stays null."""
    of = plan.where("id <> leader").select("group", F.col("id").alias(id_), F.col("leader").alias("_l"))
    return df.join(of, ["group", id_], "left").withColumn("leader", F.coalesce("_l", id_)).drop("_l")


def _named(df: DataFrame, names: DataFrame, fallback: Column, into: str) -> DataFrame:
    out = df.join(names.select("group", F.col("id").alias("leader"), F.col("name").alias("_n")), ["group", "leader"], "left")
    return out.withColumn(into, F.coalesce("_n", fallback)).drop("_n")


def merges(plan: DataFrame) -> DataFrame:
    return plan.where("id <> leader").select("group", "id", "leader")


def events(results: DataFrame, plan: DataFrame, joined: DataFrame, names: DataFrame) -> DataFrame:
    """Event results (group, deck_id, archetype_id, archetype, ...) under their leaders' ids and names; one without an
    archetype takes that of the leader it joined, if it did."""
    x = _led(results, plan, "archetype_id").join(joined.select("group", "deck_id", F.col("leader").alias("_j")), ["group", "deck_id"], "left")
    x = x.withColumn("leader", F.coalesce("leader", "_j")).withColumn("_moved", F.col("leader").isNotNull() & ~F.col("leader").eqNullSafe(F.col("archetype_id")))
    x = _named(x, names, F.coalesce("archetype", F.lit("")), "_name")
    return x.select(*(F.col("leader").alias(c) if c == "archetype_id" else F.when(F.col("_moved"), F.col("_name")).otherwise(F.col(c)).alias(c) if c == "archetype" else F.col(c) for c in results.columns))


def histories(results: DataFrame, plan: DataFrame, joined: DataFrame) -> DataFrame:
    """Results of archetypes (group, id, pos, deck_id, ...) under their leaders, each deck once: the leader's own come before its members',
    and the results that joined it (joined with the same columns and leader instead of id) last. Adds source: 0, 1 or 2."""
    rest = [c for c in results.columns if c not in ("group", "id", "deck_id")]
    x = _led(results, plan, "id").withColumn("source", F.when(F.col("id") == F.col("leader"), 0).otherwise(1))
    x = x.unionByName(joined.withColumns({"id": F.col("leader"), "source": F.lit(2)}).select(x.columns))
    first = x.groupBy("group", "leader", "deck_id").agg(F.min(F.struct("source", "id", *rest)).alias("_r"))
    return first.select("group", "leader", "deck_id", "_r.source", *(f"_r.{c}" for c in rest))


def colors_of_groups(decks: DataFrame, plan: DataFrame, joined: DataFrame, known: DataFrame) -> DataFrame:
    """(group, leader, colors): the colours that at least half of a group's decks with known colours play, sorted. decks: group, id,
    deck_id of every result; known: deck_id, colors. Groups without a known deck have no row."""
    of = _led(decks, plan, "id").select("group", "leader", "deck_id").unionByName(joined.select("group", "leader", "deck_id")).distinct().join(known, "deck_id")
    n = of.groupBy("group", "leader").agg(F.count(F.lit(1)).alias("_n"))
    each = of.select("group", "leader", F.explode("colors").alias("c")).groupBy("group", "leader", "c").agg(F.count(F.lit(1)).alias("_k"))
    listed = each.join(n, ["group", "leader"]).where("2 * _k >= _n").groupBy("group", "leader").agg(F.array_sort(F.collect_list("c")).alias("colors"))
    return n.join(listed, ["group", "leader"], "left").select("group", "leader", F.coalesce("colors", F.array().cast(known.schema["colors"].dataType)).alias("colors"))


def metagame(tiles: DataFrame, plan: DataFrame, names: DataFrame, colors: DataFrame) -> DataFrame:
    """One tile per leader and window: shares and deck counts added up (unknown if one is), the rest from the leader's own tile, else
    from its tile in the longest window that has one, else from the member that the window lists first.

    tiles: group, days, pos, id, name, percentage, deck_count, colors and others. colors: as colors_of_groups gives them; a group without
    takes those of the tile.
    """
    rest = [c for c in tiles.columns if c not in ("group", "days", "id", "percentage", "deck_count", "pos")]
    tile = F.struct(*rest)
    x = _led(tiles, plan, "id").withColumn("_tile", tile)
    own = F.when(F.col("id") == F.col("leader"), F.col("_tile"))
    merged = x.groupBy("group", "days", "leader").agg(
        F.round(F.sum("percentage"), 1).alias("percentage"),
        F.when(F.count("deck_count") == F.count(F.lit(1)), F.sum("deck_count")).alias("deck_count"),
        F.max(own).alias("_own"),
        F.min_by("_tile", "pos").alias("_first"),
    )
    longest = tiles.withColumn("_tile", tile).groupBy("group", F.col("id").alias("leader")).agg(F.max_by("_tile", "days").alias("_long"))
    x = merged.join(longest, ["group", "leader"], "left").withColumn("_base", F.coalesce("_own", "_long", "_first"))
    x = x.join(colors.withColumnRenamed("colors", "_colors"), ["group", "leader"], "left")
    x = _named(x, names, F.col("_base.name"), "_name")
    shown = {"name": F.col("_name"), "colors": F.coalesce("_colors", "_base.colors")}
    return x.select("group", "days", F.col("leader").alias("id"), "percentage", "deck_count", *(shown.get(c, F.col(f"_base.{c}")).alias(c) for c in rest))
