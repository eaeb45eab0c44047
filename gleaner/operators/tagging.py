"""Events tagged by name: region by keyword, format tags, and the cascade from hand-kept tags to cached answers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

#: The formats in the order they are listed, words that mean one, and event types that settle one.
FORMATS = ["Standard", "Pioneer", "Modern", "Legacy", "Vintage", "Pauper", "Commander", "Limited", "Brawl", "Historic", "Alchemy", "Timeless"]
WORDS = {"draft": "Limited", "sealed": "Limited"}
OF_TYPE = {"CommandFest": ["Commander"]}
#: Regions in the order they are tried, with the places and series that belong to each.
REGIONS = {
    "southeast_asia": ["Singapore", "Kuala Lumpur", "Bangkok", "Manila", "Jakarta", "Ho Chi Minh", "Hanoi", "SEA Championship"],
    "japan": ["Japan", "Tokyo", "Yokohama", "Osaka", "Chiba", "Champions Cup"],
    "chinese_taipei": ["Taipei", "Taiwan", "MIT Championship"],
    "china": ["China", "Hangzhou", "Shanghai", "Beijing", "Shenzhen", "Dragon Shield Cup"],
    "korea": ["Korea", "Seoul"],
    "australia_nz": ["Australia", "Sydney", "Melbourne", "Brisbane", "Auckland", "New Zealand", "Super Series"],
    "usa": ["USA", "United States", "SCG", "Los Angeles", "Baltimore", "Atlanta", "Las Vegas", "Orlando", "Sacramento", "Elmhurst", "Alexandria", "Chicago", "Dallas", "Seattle"],
    "canada": ["Canada", "Ottawa", "Toronto", "Montreal", "Vancouver", "F2F Tour"],
    "europe": ["EMEA", "Europe", "Ghent", "Bologna", "Leicester", "Marl", "Lyon", "Paris", "London", "Barcelona", "Madrid", "Berlin", "Amsterdam", "Utrecht", "Prague", "Warsaw", "Lisbon", "Milan", "Naples"],
    "mexico_central_america": ["Mexico", "Central America", "Caribbean", "Guatemala", "Costa Rica"],
    "south_america": ["South America", "Buenos Aires", "São Paulo", "Sao Paulo", "Santiago", "Bogotá", "Bogota", "Lima", "Brazil", "Argentina", "Chile"],
}


def region(name: Column, regions: dict[str, list[str]] = REGIONS) -> Column:
    """The first region of which a keyword is in the name, whatever its case; null if there is none."""
    low = F.lower(name)
    found = F.lit(None).cast("string")
    for label, keywords in reversed(regions.items()):
        found = F.when(low.rlike("|".join(re.escape(k.lower()) for k in keywords)), label).otherwise(found)
    return found


def in_order(tags: Column, order: list[str] = FORMATS) -> Column:
    """The known ones among tags, each once, in the fixed order."""
    return F.filter(F.array(*map(F.lit, order)), lambda t: F.coalesce(F.array_contains(tags, t), F.lit(False)))


def name_tags(name: Column, kind: Column) -> Column:
    """The formats that a name's whole words or the event's type settle."""
    said = lambda words: name.rlike(r"(?iU)(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)")
    rules = []
    for tag in FORMATS:
        words = [tag, *(w for w, t in WORDS.items() if t == tag)]
        types = [k for k, tags in OF_TYPE.items() if tag in tags]
        rules.append(F.when(F.coalesce(said(words), F.lit(False)) | F.coalesce(kind.isin(*types), F.lit(False)), F.lit(tag)))
    return F.filter(F.array(*rules), lambda t: t.isNotNull())


def article(url: Column, hosts: list[str]) -> Column:
    """url if it is an https page of one of the hosts, other than its front page and schedule; else null."""
    host = F.lower(F.regexp_extract(url, r"^https://([^/?#:]+)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^https://[^/?#]+([^?#]*)", 1), "/+$", "")
    return F.when(host.isin(*hosts) & ~path.isin("", "/schedule"), url)


def tagged(events: DataFrame, overrides: DataFrame, cache: DataFrame, pages: DataFrame, hosts: list[str]) -> DataFrame:
    """events (id, name, type, url) with formats, where they come from, and whether the answer is still to be asked for.

    Hand-kept tags of overrides (id, tags) win, also empty ones; then what name and type settle; then the cached answer
    (id, hash, tags) if it was given for this name and this text of the article. pages (url, text) holds the articles that
    could be read; an event whose article could not keeps its cached answer.
    """
    x = events.withColumn("_rule", name_tags(F.col("name"), F.col("type"))).withColumn("_url", article(F.col("url"), hosts))
    x = x.join(overrides.select("id", F.col("tags").alias("_kept"), F.lit(True).alias("_own")), "id", "left")
    x = x.join(cache.select("id", F.col("hash").alias("_hash"), F.col("tags").alias("_said")), "id", "left")
    x = x.join(pages.select(F.col("url").alias("_url"), F.col("text").alias("_text")), "_url", "left")
    digest = F.sha2(F.concat_ws("\n", "name", "_text").cast("binary"), 256)
    rows = F.when(F.col("_own"), "override").when(F.size("_rule") > 0, "rule").when(F.col("_url").isNull(), "none")
    rows = rows.when(F.col("_said").isNotNull() & (F.col("_text").isNull() | (F.col("_hash") == digest)), "cache").when(F.col("_text").isNull(), "none").otherwise("due")
    x = x.withColumn("source", rows)
    tags = F.when(F.col("source") == "override", F.col("_kept")).when(F.col("source") == "rule", F.col("_rule")).when(F.col("source") == "cache", F.col("_said"))
    return x.select(*events.columns, in_order(F.coalesce(tags, F.array().cast("array<string>"))).alias("formats"), "source")


def address(*parts: Column) -> Column:
    """The parts that are there and not empty, with commas."""
    return F.concat_ws(", ", *(F.nullif(p, F.lit("")) for p in parts))
