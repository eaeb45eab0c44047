"""Entries of JSON pages whose schema drifts: variants, with a check of each field's type. A field of another type counts as absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_CARD = "$.container.json_dict.card"


def _typed(body: Column, path: str, kinds: str, cast: str) -> Column:
    x = F.try_variant_get(body, path, "variant")
    return F.when(F.schema_of_variant(x).rlike(f"^(?:{kinds})"), F.try_variant_get(x, "$", cast))


def whole(body: Column, path: str) -> Column:
    return _typed(body, path, "BIGINT|DECIMAL\\(\\d+,0\\)", "bigint")


def number(body: Column, path: str) -> Column:
    return _typed(body, path, "BIGINT|DECIMAL|DOUBLE|FLOAT", "double")


def words(body: Column, path: str) -> Column:
    """A string that is not empty."""
    return F.nullif(_typed(body, path, "STRING", "string"), F.lit(""))


def each(body: Column, path: str) -> Column:
    """The items of an array, none if it is anything else."""
    return F.coalesce(F.try_variant_get(body, path, "array<variant>"), F.array().cast("array<variant>"))


def parsed(pages: DataFrame, key: str, body: str) -> DataFrame:
    """key and the page as a variant `page`; null where it is no JSON."""
    return pages.select(key, F.try_parse_json(body).alias("page"))


def entries(pages: DataFrame, key: str) -> DataFrame:
    """The entry of each page with a positive number of decks: name, decks, of_decks (if positive), salt (two places), lands, basics,
    and bracket_decks (a map of the levels 1 to 5 to whole numbers)."""
    p = F.col("page")
    levels = F.array(*(F.struct(F.lit(str(n)).alias("k"), whole(p, f"$.bracket_counts['{n}']").alias("v")) for n in range(1, 6)))
    brackets = F.map_from_entries(F.filter(levels, lambda x: x["v"].isNotNull()))
    of = whole(p, f"{_CARD}.potential_decks")
    out = pages.select(key, words(p, f"{_CARD}.name").alias("name"), whole(p, f"{_CARD}.num_decks").alias("decks"), F.when(of > 0, of).alias("of_decks"), F.round(number(p, f"{_CARD}.salt"), 2).alias("salt"), whole(p, "$.land").alias("lands"), whole(p, "$.basic").alias("basics"), brackets.alias("bracket_decks"))
    return out.where("decks > 0")


def sections(pages: DataFrame, key: str) -> DataFrame:
    """A row per card of a page's lists: list (its place), tag, header, pos (place among the list's good cards), name, decks, of_decks
    (the page's decks where the card has none), synergy. Cards without a name or a whole number of decks are left out."""
    decks = whole(F.col("page"), f"{_CARD}.num_decks")
    lists = pages.select(key, decks.alias("_decks"), F.posexplode(each(F.col("page"), "$.container.json_dict.cardlists")).alias("list", "_l"))
    view = lambda v: F.struct(words(v, "$.name").alias("name"), whole(v, "$.num_decks").alias("decks"), whole(v, "$.potential_decks").alias("of"), F.round(number(v, "$.synergy"), 2).alias("synergy"), words(v, "$.sanitized").alias("slug"), whole(v, "$.rank").alias("rank"), F.round(number(v, "$.trend_zscore"), 1).alias("trend"))
    good = F.filter(F.transform(each(F.col("_l"), "$.cardviews"), view), lambda c: c["name"].isNotNull() & c["decks"].isNotNull())
    rows = lists.select(key, "_decks", "list", F.coalesce(words(F.col("_l"), "$.tag"), F.lit("")).alias("tag"), F.coalesce(words(F.col("_l"), "$.header"), F.lit("")).alias("header"), F.posexplode(good).alias("pos", "_c"))
    return rows.select(key, "list", "tag", "header", "pos", "_c.name", "_c.decks", F.coalesce(F.nullif("_c.of", F.lit(0)), "_decks").alias("of_decks"), "_c.synergy", "_c.slug", "_c.rank", "_c.trend")


def ranked(pages: DataFrame, key: str) -> DataFrame:
    """The ranked rows of a top page: its own cardviews if it has them, else those of its first list; rank is the row's own or its place
    among the rows that have a slug, a name and a number of decks."""
    own = F.try_variant_get("page", "$.cardviews", "array<variant>")
    first = F.try_variant_get("page", "$.container.json_dict.cardlists[0].cardviews", "array<variant>")
    view = lambda v: F.struct(words(v, "$.name").alias("name"), whole(v, "$.num_decks").alias("decks"), words(v, "$.sanitized").alias("slug"), whole(v, "$.rank").alias("rank"), F.round(number(v, "$.trend_zscore"), 1).alias("trend"))
    good = F.filter(F.transform(F.coalesce(own, first), view), lambda c: c["name"].isNotNull() & c["decks"].isNotNull() & c["slug"].isNotNull())
    rows = pages.select(key, F.posexplode(good).alias("_p", "_c"))
    return rows.select(key, F.coalesce("_c.rank", (F.col("_p") + 1).cast("bigint")).alias("rank"), "_c.slug", "_c.name", "_c.decks", "_c.trend")


def themes(pages: DataFrame, key: str) -> DataFrame:
    """A row per theme with a slug, a name and a number of decks; pos is its place by decks, of equals the page's order."""
    tag = lambda t, i: F.struct((-whole(t, "$.count")).alias("_n"), i.alias("_i"), words(t, "$.slug").alias("slug"), words(t, "$.value").alias("name"))
    good = F.filter(F.transform(each(F.col("page"), "$.tag_counts"), tag), lambda t: t["_n"].isNotNull() & t["slug"].isNotNull() & t["name"].isNotNull())
    rows = pages.select(key, F.posexplode(F.array_sort(good)).alias("pos", "_t"))
    return rows.select(key, (F.col("pos") + 1).alias("pos"), "_t.slug", "_t.name", (-F.col("_t._n")).alias("decks"))


def shown_themes(found: DataFrame, least: int = 30, most: int = 5) -> DataFrame:
    """The first `most` themes of at least `least` decks (pos as themes gives it)."""
    return found.where((F.col("decks") >= least) & (F.col("pos") <= most))


def usable(found: DataFrame, least: int = 30) -> DataFrame:
    """Entries of enough decks to make something of."""
    return found.where(F.col("decks") >= least)
