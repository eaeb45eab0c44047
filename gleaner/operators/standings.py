"""Rows of standings: those past the list rebuilt, primers matched through merges, key cards resolved."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.operators.priority import first_per_key


def ids_of_windows(windows: list[DataFrame], id_: str) -> DataFrame:
    """Every id of any window's standings."""
    return reduce(lambda a, b: a.union(b), (w.select(id_) for w in windows)).where(F.col(id_).isNotNull()).distinct()


def rebuilt(wanted: DataFrame, month: DataFrame, week: DataFrame, results: DataFrame, names: DataFrame, now: str, days: int = 30) -> DataFrame:
    """For each wanted id the row that standings would have: name, shares of month and week, decks of the month, top eights and
    wins within days before now, and all of its results. What a window lacks is null; the name falls back to the archetype's, then the id."""
    at = F.lit(now).cast("timestamp")
    recent = (F.col("ts") >= at - F.make_dt_interval(days=F.lit(days))) & (F.col("ts") <= at)
    counted = results.groupBy("id").agg(F.count_if(recent & (F.col("place") <= 8)).alias("top8"), F.count_if(recent & (F.col("place") == 1)).alias("wins"), F.count(F.lit(1)).alias("results"))
    m = month.select("id", F.col("name").alias("_name"), F.col("share").alias("share_30d"), F.col("decks").alias("decks_30d"))
    x = wanted.join(m, "id", "left").join(week.select("id", F.col("share").alias("share_7d")), "id", "left").join(counted, "id", "left").join(names.select("id", F.col("name").alias("_own")), "id", "left")
    return x.select("id", F.coalesce("_name", "_own", "id").alias("name"), "share_30d", "share_7d", "decks_30d", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("top8", "wins", "results")))


def matched_primers(rows: DataFrame, primers: DataFrame, merges: DataFrame) -> DataFrame:
    """(id, primer, merged): each archetype's primer. Its own come first: the one named after it, else the one updated last;
    then primers of archetypes merged into it (merges: id, leader), the latest first. primers: primer, archetype, updated."""
    own = primers.join(rows.select(F.col("id").alias("archetype")), "archetype", "left_semi").select(F.col("archetype").alias("id"), "primer", F.lit(False).alias("merged"), (F.col("primer") != F.col("archetype")).cast("int").alias("rank"), "updated")
    left = primers.join(rows.select(F.col("id").alias("archetype")), "archetype", "left_anti")
    by = lambda c, name: merges.select(F.col("id").alias(c), F.col("leader").alias(name))
    moved = left.join(by("archetype", "_a"), "archetype", "left").join(by("primer", "_p"), "primer", "left").select(F.coalesce("_a", "_p").alias("id"), "primer", F.lit(True).alias("merged"), F.lit(2).alias("rank"), "updated")
    moved = moved.join(rows.select("id"), "id", "left_semi")
    best = first_per_key(own.unionByName(moved).withColumn("_u", -F.unix_micros(F.col("updated").cast("timestamp"))), ["id"], [F.col("rank"), F.col("_u"), F.col("primer")])
    return best.select("id", "primer", "merged")


def key_cards(tiles: DataFrame, catalog: DataFrame, id_: str, cards: str, k: int) -> DataFrame:
    """(id, position, name, oracle_id): a tile's first k key cards (array of name, slug, oracle_id); an id that is missing
    comes from the catalog (slug, oracle_id)."""
    x = tiles.select(id_, F.posexplode(F.slice(cards, 1, k)).alias("position", "c")).select(id_, "position", "c.*")
    return x.join(catalog.select("slug", F.col("oracle_id").alias("_known")), "slug", "left").select(id_, "position", "name", F.coalesce("oracle_id", "_known").alias("oracle_id"))


def deck_number(tournament: Column, entries: Column, course: Column) -> Column:
    """A deck's number: its tournament's, else the first that one of its cards (an array of numbers) has, else its course's."""
    filled = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(filled(tournament), F.get(F.filter(entries, lambda e: F.coalesce(e, F.lit("")) != ""), 0), course)


def pages_index(states: DataFrame) -> DataFrame:
    """The index of pages that a run can link to: slug, name and decks of every page ever read, in order of slug."""
    return states.where(F.col("checked_at").isNotNull()).select("slug", "name", "decks").orderBy("slug")


def entity_pages(items: DataFrame) -> DataFrame:
    """Per entity: the sources of its items, each page once with its first citation, and everyone they mention, sorted.
    items: entity, pos, page, citation, who (array)."""
    sources = first_per_key(items.select("entity", "page", "pos", "citation"), ["entity", "page"], [F.col("pos")])
    cited = sources.groupBy("entity").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("page", "citation")))).alias("sources"))
    said = items.select("entity", F.explode("who").alias("name")).where("name is not null and name <> ''").groupBy("entity").agg(F.array_sort(F.collect_set("name")).alias("mentioned"))
    return cited.join(said, "entity", "left").join(items.groupBy("entity").agg(F.count(F.lit(1)).alias("n_items")), "entity")
