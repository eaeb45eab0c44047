"""Values resolved by chains of fallbacks, duplicates by several rules, and what is picked where there is too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.functions import text as tx
from gleaner.operators.priority import first_per_key, top_per_group

#: Types of entities that are shown, those that are characters, and the lands of a list without much else to go by.
SHOWN, CHARACTERS, LANDS = ["character", "creature", "deity", "plane", "location", "faction", "artifact"], ["character", "creature", "deity"], 36


def duplicate_pages(pages: DataFrame) -> DataFrame:
    """(key): pages that repeat another. pages: key, kind, title, paragraphs.

    Stories with one title and the same paragraphs after the first, of which the first by key stays (copies marked -0 last);
    archived columns whose keys differ in the date only, under one title, of which the earliest stays; and a page whose key
    is another's with -0 under the same title.
    """
    title, copy = F.lower(F.trim("title")), F.col("key").endswith("-0")
    story = pages.where("kind = 'story'").select("key", F.struct(title.alias("t"), F.sha2(F.to_json(F.slice("paragraphs", 2, F.greatest(F.size("paragraphs"), F.lit(1)))), 256).alias("b")).alias("same"), copy.cast("string").alias("o"))
    dated = r"-(\d{4}-\d{2}-\d{2})(-\d+)?$"
    day = F.coalesce(F.nullif(F.regexp_extract("key", dated, 1), F.lit("")), F.lit("9999"))
    column = pages.where("kind = 'archive'").select("key", F.struct(title.alias("t"), F.regexp_replace("key", dated, "").alias("b")).alias("same"), day.alias("o"))

    def later(df: DataFrame) -> DataFrame:
        kept = df.groupBy("same").agg(F.min_by("key", F.struct("o", "key")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "kept")
        return df.join(kept, "same").where("key <> kept").select("key")

    marked = pages.where(copy).select("key", title.alias("t"), F.expr("left(key, length(key) - 2)").alias("of"))
    again = marked.join(pages.select(F.col("key").alias("of"), title.alias("t")), ["of", "t"], "left_semi").select("key")
    return later(story).union(later(column)).union(again).distinct()


def reminder(keyword: Column, text: Column) -> Column:
    """The reminder in parentheses that follows the keyword on one of the text's lines, with a few words between at most; the
    first one, without its parentheses; empty if there is none."""
    word = F.concat(F.lit(r"(?i)(?<![A-Za-z])\Q"), F.replace(keyword, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E(?![A-Za-z])[^().\n]{0,60}\.?[^\S\n]*\(([^)\n]+)\)"))
    return F.trim(F.coalesce(F.call_function("regexp_extract", text, word, F.lit(1)), F.lit("")))


def era(sets: DataFrame, events: DataFrame, column: str) -> DataFrame:
    """events with era_label and era_day: the set's that its era names by code, else the middle of a year from 1993 to 2029."""
    code = F.lower(F.trim(F.col(column)))
    known = sets.where("day is not null").select(F.col("code").alias("_code"), F.col("label").alias("_label"), F.col("day").alias("_day"))
    x = events.withColumn("_code", code).join(known, "_code", "left")
    year = F.col("_code").rlike(r"^(199[3-9]|20[0-2]\d)$")
    label = F.when(F.col("_day").isNotNull(), F.col("_label")).when(year, F.col("_code"))
    return x.withColumn("era_label", label).withColumn("era_day", F.coalesce("_day", F.when(year, F.try_to_date(F.concat("_code", F.lit("-07-01")))))).drop("_code", "_label", "_day")


def event_sets(events: DataFrame, story: DataFrame, codes: DataFrame, storylines: DataFrame, days: DataFrame) -> DataFrame:
    """events (page, era, storyline, day) with the set they belong to: the code of a page of cards, if that is a story's; else
    the era, if it is a code; else the storyline's; else the day's. story, codes: code; storylines: storyline, code; days: day, code."""
    card = F.regexp_extract("page", "^cards/(.+)$", 1)
    x = events.withColumn("_card", card)
    x = x.join(story.select(F.col("code").alias("_card"), F.lit(True).alias("_is")), "_card", "left").join(codes.select(F.col("code").alias("era"), F.lit(True).alias("_era")), "era", "left")
    x = x.join(storylines.select("storyline", F.col("code").alias("_line")), "storyline", "left").join(days.select("day", F.col("code").alias("_day")), "day", "left")
    found = F.when(F.col("_card") != "", F.when(F.col("_is"), F.col("_card"))).otherwise(F.coalesce(F.when(F.col("_era"), F.col("era")), "_line", "_day"))
    return x.withColumn("set", found).drop("_card", "_is", "_era", "_line", "_day")


def shown_type(kind: Column, description: Column, walker: Column) -> Column:
    """The type an entity is shown as: planeswalkers by list or description, characters, or its own; null if it is not shown."""
    character = F.when(walker | F.contains(F.lower(F.coalesce(description, F.lit(""))), F.lit("planeswalker")), "planeswalker").otherwise("character")
    return F.when(kind.isin(*CHARACTERS), character).when(kind.isin(*SHOWN), kind)


def land_target(ramp: Column, mana_value: Column) -> Column:
    return F.lit(LANDS) - (ramp >= 12).cast("int") + (mana_value > 3.5).cast("int")


def looked_up(names: DataFrame, catalog: DataFrame, name: str) -> DataFrame:
    """names with colors and oracle_id of the catalog (slug, colors, oracle_id); a name that it lacks and that has two halves
    gets the colours of both, in order, if both are known, and no id."""
    halves = F.split(F.col(name), " // ")
    keyed = lambda c, p: catalog.select(F.col("slug").alias(c), F.col("colors").alias(f"_c{p}"), F.col("oracle_id").alias(f"_o{p}"), F.lit(True).alias(f"_k{p}"))
    x = names.withColumn("_0", tx.ascii_slug(F.col(name))).withColumn("_1", F.when(F.size(halves) == 2, tx.ascii_slug(halves[0]))).withColumn("_2", F.when(F.size(halves) == 2, tx.ascii_slug(F.get(halves, 1))))
    for p in (0, 1, 2):
        x = x.join(keyed(f"_{p}", p), f"_{p}", "left")
    both = F.filter(F.array(*map(F.lit, "WUBRG")), lambda c: F.array_contains("_c1", c) | F.array_contains("_c2", c))
    colors = F.when(F.col("_k0"), F.col("_c0")).when(F.col("_c1").isNotNull() & F.col("_c2").isNotNull(), both)
    return x.select(*names.columns, colors.alias("colors"), F.col("_o0").alias("oracle_id"))


def picked(events: DataFrame, group: str, pos: str, count: int) -> DataFrame:
    """The events that tell each group's arc, count at most: its story's own if they are enough, major ones first, spread from
    beginning to end. events: group, pos, story and major (booleans)."""
    w = Window.partitionBy(group)
    n = lambda c: F.sum(c.cast("int")).over(w)
    x = events.withColumn("_all", F.count(F.lit(1)).over(w)).withColumn("_own", n(F.col("story")) >= count)
    x = x.where((F.col("_all") <= count) | ~F.col("_own") | F.col("story")).withColumn("_majors", n(F.col("major"))).withColumn("_of", F.count(F.lit(1)).over(Window.partitionBy(group, "major")))
    x = x.withColumn("_i", F.row_number().over(Window.partitionBy(group, "major").orderBy(pos)) - 1)
    want = F.when(F.col("major"), F.least("_majors", F.lit(count))).otherwise(F.greatest(F.lit(count) - F.col("_majors"), F.lit(0)))
    # Of n events k are spread as round(i * (n - 1) / (k - 1)), ties to even, for i below k; one alone is the first.
    spots = F.when(want == 1, F.array(F.lit(0.0))).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(want - 1, F.lit(0)).cast("int")), lambda i: F.rint(i * (F.col("_of") - 1) / F.greatest(want - 1, F.lit(1)))))
    kept = (F.col("_all") <= count) | (F.col("_of") <= want) | ((want > 0) & F.array_contains(spots, F.col("_i").cast("double")))
    return x.where(kept).select(*events.columns)


def first_existing(rows: DataFrame, pages: DataFrame, row: str, candidates: str, order: list[Column], most: int) -> DataFrame:
    """Rows matched to the first of their candidates (array of slugs) that is a page; each page once, for the first row in
    order; the first most of them with their rank. pages: slug and its columns."""
    each = rows.select(row, F.struct(*order).alias("_order"), F.posexplode(candidates).alias("_i", "slug")).join(pages.select("slug"), "slug", "left_semi")
    best = first_per_key(each, [row], [F.col("_i")]).drop("_i")
    distinct = first_per_key(best, ["slug"], [F.col("_order"), F.col(row)])
    return top_per_group(distinct.withColumn("_one", F.lit(1)), ["_one"], [F.col("_order"), F.col(row)], most).drop("_one", "_order").join(pages, "slug")


def filled_ids(rows: DataFrame, catalog: DataFrame, name: str, id_: str) -> tuple[DataFrame, DataFrame]:
    """rows with missing ids filled from the catalog (slug, id) by name, and the distinct names that it lacks."""
    x = rows.withColumn("_s", tx.ascii_slug(F.col(name))).join(catalog.select(F.col("slug").alias("_s"), F.col("id").alias("_id")), "_s", "left")
    out = x.withColumn(id_, F.coalesce(id_, "_id")).drop("_s", "_id")
    return out, out.where(F.col(id_).isNull()).select(name).distinct()


def carried_over(old: DataFrame, new: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """The old answers (group, keys, answer) of groups whose keys are exactly those that the new run has; others are written anew."""
    a, b = old.select(group, *keys).distinct().withColumn("_a", F.lit(1)), new.select(group, *keys).distinct().withColumn("_b", F.lit(1))
    differ = a.join(b, [group, *keys], "full").where("_a is null or _b is null").select(group).distinct()
    return old.join(differ, group, "left_anti")


def alias_edges(named: DataFrame) -> DataFrame:
    """(name, alias): which name an alias is joined to. named: page, name, alias, all folded.

    An alias of one name joins it unless it is another's name that it does not shorten; one of several goes, if it is a name,
    to the name it shortens that is on most pages, the last of equals. An alias shortens a name of which its words are a
    proper part.
    """
    pages = named.select("page", "name").distinct().groupBy("name").agg(F.count(F.lit(1)).alias("pages"))
    pairs = named.select("name", "alias").where("alias <> '' and alias <> name").distinct()
    owners = pairs.groupBy("alias").agg(F.count(F.lit(1)).alias("owners"))
    words = lambda c: F.split(F.col(c), " ")
    short = (F.size(F.array_except(words("alias"), words("name"))) == 0) & (F.size(words("alias")) < F.size(words("name")))
    is_name = pages.select(F.col("name").alias("alias"), F.lit(True).alias("taken"))
    x = pairs.join(owners, "alias").join(is_name, "alias", "left").join(pages, "name").withColumn("short", short)
    one = x.where("owners = 1 and (taken is null or short)").select("name", "alias")
    top = x.where("owners > 1 and taken and short").groupBy("alias").agg(F.max_by("name", F.struct("pages", "name")).alias("name")).select("name", "alias")
    return one.union(top)


def matchups(markdown: DataFrame, key: str, text: str) -> DataFrame:
    """The matchup blocks of primers: key, block, name, archetype, and the cards to bring in and take out (quantity, name)."""
    lines = markdown.select(key, F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    head = r'^:::matchup\s+"([^"]*)"(.*)$'
    opens, ends = F.col("line").rlike(head), F.col("line") == ":::"
    w = Window.partitionBy(key).orderBy("pos")
    x = lines.withColumn("block", F.sum(opens.cast("int")).over(w)).where("block > 0")
    x = x.withColumn("_over", F.sum(ends.cast("int")).over(Window.partitionBy(key, "block").orderBy("pos"))).where("_over = 0")
    found = lambda side: F.when(F.lower("line").startswith(f"{side}:"), F.regexp_extract_all("line", F.lit(r"(\d+\s*\[\[[^\]|]+)"), F.lit(1)))
    cards = lambda side: F.transform(F.flatten(F.array_compact(F.transform(F.array_sort(F.collect_list(F.struct("pos", found(side).alias("c")))), lambda s: s["c"]))), lambda c: F.struct(F.regexp_extract(c, r"^(\d+)", 1).cast("int").alias("quantity"), F.trim(F.regexp_replace(c, r"^\d+\s*\[\[", "")).alias("name")))
    first = F.min_by("line", "pos")
    return x.groupBy(key, "block").agg(F.regexp_extract(first, head, 1).alias("name"), F.nullif(F.regexp_extract(F.regexp_extract(first, head, 2), r"\barchetype=(\S+)", 1), F.lit("")).alias("archetype"), cards("in").alias("in"), cards("out").alias("out"))
