"""Citations of pages, sentences and primer text, and links chosen from a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def column_name(url: Column, columns: dict[str, str], otherwise: str) -> Column:
    """The name of the column that a URL belongs to: the first key that is a whole part of its path, or a value at its end or before a
    year."""
    out = F.lit(otherwise)
    for key, name in reversed(columns.items()):
        out = F.when(F.lower(url).rlike(rf"[/=]\Q{key}\E(?:/|-\d{{4}}|$)"), name).otherwise(out)
    return out


def citation(source: Column, kind: Column, title: Column, url: Column, archived: Column, authors: Column, date: Column, section: Column, license_: Column, columns: dict[str, str]) -> Column:
    """work, series, publisher, official, url, link, archived, license and text of a page's citation, by its source: a wiki (licensed, not
    official), an archive (the archived copy is linked, the original cited), or the publisher's own page. date is shown as given."""
    name = F.coalesce(title, F.lit(""))
    when = F.when(F.coalesce(date, F.lit("")) != "", F.concat(F.lit(", "), date)).otherwise("")
    by = F.when(F.size(F.coalesce(authors, F.array().cast("array<string>"))) > 0, F.concat(F.lit(" by "), F.array_join(authors, ", "))).otherwise("")
    licensed = F.trim(F.split_part(F.coalesce(F.nullif(license_, F.lit("")), F.lit("CC BY-NC-SA 4.0")), F.lit(","), F.lit(1)))
    part = F.when(F.coalesce(section, F.lit("")) != "", F.concat(F.lit(', section "'), section, F.lit('"'))).otherwise("")
    wiki, old = source == "wiki", source == "archive"
    work = F.when(~wiki & ~old & (kind == "profile"), F.regexp_replace(name, r"\s*\|\s*(?:Planeswalker|Plane)$", "")).otherwise(name)
    series = F.when(wiki, "Wiki").when(old, column_name(url, columns, "archive")).when(kind == "story", "Stories").otherwise("Profiles")
    text = (
        F.when(wiki, F.concat(F.lit('"'), name, F.lit('"'), part, F.lit(". Wiki contributors, "), licensed, F.lit(".")))
        .when(old, F.concat(F.lit('"'), name, F.lit('". '), series, F.lit(", Publisher"), when, F.lit(". Archived.")))
        .otherwise(F.concat(F.lit('"'), work, F.lit('"'), by, F.lit(". "), series, F.lit(", Publisher"), when, F.lit(".")))
    )
    return F.struct(
        work.alias("work"), series.alias("series"), F.when(wiki, "Wiki contributors").otherwise("Publisher").alias("publisher"), (~wiki).alias("official"), url.alias("url"),
        F.when(old, F.coalesce(archived, url)).otherwise(url).alias("link"), F.when(old, archived).alias("archived"), F.when(wiki, licensed).alias("license"), text.alias("text"),
    )


def sentence(text: Column) -> Column:
    """text without white space around it and with a full stop, unless it ends in a mark, a quote or a bracket, or is empty."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when((t == "") | t.rlike("[.!?\"”’)]$"), t).otherwise(F.concat(t, F.lit(".")))


def primer(text: Column, cards: Column) -> Column:
    """text in which double brackets mean a card: those around a name in cards stay, others become single."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)\[\[[^\[\]]*\]\]|(?:(?!\[\[[^\[\]]*\]\]).)+"), F.lit(0))
    link = lambda p: p.rlike(r"^\[\[[^\[\]]*\]\]$") & F.array_contains(cards, F.substring(p, F.lit(3), F.length(p) - 4))
    plain = lambda p: F.replace(F.replace(p, F.lit("[["), F.lit("[")), F.lit("]]"), F.lit("]"))
    return F.trim(F.array_join(F.transform(parts, lambda p: F.when(link(p), p).otherwise(plain(p))), ""))


def chosen_link(links: Column, host: str, ending: str, preferred: str) -> Column:
    """Of links the first on host that ends so (blanks as %20) and holds the preferred word, else the first that ends so; null if none does."""
    clean = F.transform(links, lambda u: F.replace(F.trim(u), F.lit(" "), F.lit("%20")))
    fits = F.filter(clean, lambda u: F.lower(u).rlike(rf"^https?://\Q{host}\E/[^?#]*\Q{ending}\E(?:[?#]|$)"))
    return F.coalesce(F.get(F.filter(fits, lambda u: F.contains(F.lower(u), F.lit(preferred))), F.lit(0)), F.get(fits, F.lit(0)))


def listed_paths(html: Column, under: str) -> Column:
    """The distinct paths below a folder that a listing links to, in its order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(rf'href="(\Q{under}\E[^"#?]+)"'), F.lit(1)))


def told_total(html: Column) -> Column:
    """How many entries a listing says it has in all; null if it doesn't."""
    return F.regexp_extract(html, r"totalRows:(\d+)", 1).try_cast("bigint")


def link_only(text: Column, links: Column) -> Column:
    """Whether a paragraph is nothing but its links' texts (each once) and signs between them."""
    cut = F.aggregate(links, text, lambda rest, link: F.when((link != "") & (F.call_function("instr", rest, link) > 0), F.call_function("overlay", rest, F.lit(""), F.call_function("instr", rest, link), F.length(link))).otherwise(rest))
    return (F.size(links) > 0) & (F.regexp_replace(cut, r"[\s|·•,;:/-]+", "") == "")


def first_tagged(sections: DataFrame, key: str, tags: list[str], most: int) -> DataFrame:
    """The first `most` cards of each page's first list with one of tags, in the order of tags: key, pos, name, decks, share (per cent of
    of_decks, one place), synergy. sections: as sources.pagejson.sections gives them."""
    place = F.array_position(F.array(*map(F.lit, tags)), F.col("tag"))
    known = sections.where(place > 0).withColumn("_p", F.struct(place.alias("p"), (-F.col("list")).alias("l")))
    best = known.groupBy(key).agg(F.min("_p").alias("_best"))
    x = known.join(best, key).where((F.col("_p") == F.col("_best")) & (F.col("pos") < most))
    return x.select(key, "pos", "name", "decks", F.round(F.col("decks") * 100 / F.nullif("of_decks", F.lit(0)), 1).alias("share"), "synergy")
