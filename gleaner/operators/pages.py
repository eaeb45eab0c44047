"""What kinds of pages say, from the rows of their elements: indexes, event lists, placements, articles, wikis, rule books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.operators.priority import first_per_key
from gleaner.operators.texts import longest_prefix
from gleaner.sources import html

#: Sections of wiki pages that are no story, and lines of profiles that are on all of them.
WIKI_SKIP = (
    "contents|gallery|references|notes|see also|external links|in-game references|story appearances|planes visited|card list|cards|trivia|appearances|other appearances|"
    "rules|rulings|tokens|reprints|art|artwork|art depiction controversy|flavor text quotes|quotes"
)
BOILERPLATE = ["EXPLORE THE LORE", "Take off on your next adventure with stories from across the Magic multiverse!"]


def attr(name: str) -> Column:
    return F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit(""))


def has_class(name: str) -> Column:
    return F.array_contains(F.split(attr("class"), r"\s+"), name)


def month_index(pages: DataFrame, key: str, body: str, formats: DataFrame) -> DataFrame:
    """The events that an index page lists, in page order: key, pos, event_id, slug, format, words, name, day.

    An address ends with the day and the id; its head starts with a format's prefix (formats: prefix, format, the longest
    one counts). Events of other formats and later copies of an address are left out; without a heading the words are the name.
    """
    e = html.elements(pages, key, body, ["a", "h3"], ["li"])
    items = e.where((F.col("tag") == "li") & has_class("decklists-item")).select(key, F.col("pos").alias("item"))
    links = e.where((F.col("tag") == "a") & has_class("decklists-link")).select(key, "pos", F.regexp_extract(attr("href"), "^/decklist/(.+)$", 1).alias("slug"), F.explode("within").alias("item"))
    links = links.join(items, [key, "item"], "left_semi").select(key, "pos", "slug").distinct()
    headings = e.where(F.col("tag") == "h3").select(key, F.col("pos").alias("h"), F.col("text").alias("heading"), F.explode("within").alias("pos"))
    titled = first_per_key(headings, [key, "pos"], [F.col("h")]).drop("h")
    tail = r"^(.+?)-(\d{4}-\d{2}-\d{2})(\d+)$"
    rows = links.where(F.col("slug").rlike(tail)).withColumn("head", F.regexp_extract("slug", tail, 1))
    known = longest_prefix(rows, formats.select(F.concat("prefix", F.lit("-")).alias("prefix")), "head", "prefix").where("prefix is not null")
    known = known.join(formats.select(F.concat("prefix", F.lit("-")).alias("prefix"), "format"), "prefix").join(titled, [key, "pos"], "left")
    words = F.substring(F.col("head"), F.length("prefix") + 1, F.length("head"))
    out = known.select(
        key, "pos", "slug", "format", F.regexp_extract("slug", tail, 3).alias("event_id"), words.alias("words"),
        F.coalesce(F.nullif("heading", F.lit("")), F.initcap(F.replace(words, F.lit("-"), F.lit(" ")))).alias("name"), F.try_to_date(F.regexp_extract("slug", tail, 2)).alias("day"),
    )
    return first_per_key(out, [key, "slug"], [F.col("pos")])


def event_list(pages: DataFrame, key: str, body: str) -> DataFrame:
    """The dated rows of a list page, the first of each event: key, event_id, title, day, and whether a next page exists."""
    e = html.elements(pages, key, body, ["a", "td"], ["tr"])
    rows = e.where(F.col("tag") == "tr").select(key, F.col("pos").alias("row"))
    inside = lambda x: x.withColumn("row", F.explode("within")).join(rows, [key, "row"], "left_semi")
    number = F.regexp_extract(attr("href"), r"event\?e=(\d+)", 1)
    links = first_per_key(inside(e.where((F.col("tag") == "a") & (number != "")).withColumn("event_id", number)).select(key, "row", "pos", "event_id", F.col("text").alias("title")), [key, "row"], [F.col("pos")])
    date = r"(\d{2})/(\d{2})/(\d{2})"
    days = inside(e.where((F.col("tag") == "td") & has_class("S12") & F.col("text").rlike(date)))
    days = days.select(key, "row", "pos", F.try_to_date(F.regexp_replace(F.regexp_extract("text", date, 0), date, "20$3-$2-$1")).alias("day"))
    dated = links.drop("pos").join(first_per_key(days, [key, "row"], [F.col("pos")]).drop("pos"), [key, "row"])
    first = first_per_key(dated, [key, "event_id"], [F.col("row")]).drop("row")
    more = e.where((F.col("tag") == "a") & (F.col("text") == "Next") & F.contains(attr("href"), F.lit("cp="))).select(key).distinct().withColumn("has_next", F.lit(True))
    return first.join(more, key, "left").withColumn("has_next", F.coalesce("has_next", F.lit(False)))


def placements(pages: DataFrame, key: str, body: str) -> DataFrame:
    """The placed decks of an event page: key, place, deck_id, archetype, family_id, player. A place without a linked deck or
    without a player is left out."""
    e = html.elements(pages, key, body, ["a", "div"], ["img"]).withColumn("row", F.try_element_at("within", F.lit(-1)))
    places = e.where((F.col("tag") == "div") & has_class("S14") & attr("style").rlike(r"width:\s*42px")).select(key, "pos", "row", F.col("text").alias("place"))
    around = e.select(key, "pos", "tag", "attrs", "text", F.explode("within").alias("row"))
    deck, thumb = F.regexp_extract(attr("href"), r"[?&]d=(\d+)", 1), F.regexp_extract(attr("src"), r"/metas_thumbs/(\d+)\.", 1)
    first = lambda df: first_per_key(df, [key, "row"], [F.col("pos")]).drop("pos")
    decks = first(around.where((F.col("tag") == "a") & (deck != "") & (F.col("text") != "")).select(key, "row", "pos", deck.alias("deck_id"), F.col("text").alias("archetype")))
    players = first(around.where((F.col("tag") == "a") & has_class("player")).select(key, "row", "pos", F.col("text").alias("player")))
    families = first(around.where((F.col("tag") == "img") & (thumb != "")).select(key, "row", "pos", thumb.alias("family_id")))
    return places.join(decks, [key, "row"]).join(players, [key, "row"]).join(families, [key, "row"], "left").select(key, "place", "deck_id", "archetype", "family_id", "player")


def profile(pages: DataFrame, key: str, body: str) -> DataFrame:
    """Paragraphs and headings of a page's article (else its main part, else all), without boilerplate: key, pos, text."""
    e = html.elements(pages, key, body, ["p", "h2", "h3"], ["article", "main", "body"])
    roots = e.where(F.col("tag").isin("article", "main", "body")).select(key, F.col("pos").alias("root"), F.array_position(F.array(*map(F.lit, ["article", "main", "body"])), F.col("tag")).alias("rank"))
    best = first_per_key(roots, [key], [F.col("rank"), F.col("root")]).drop("rank")
    kept = e.where(F.col("tag").isin("p", "h2", "h3") & (F.col("text") != "") & ~F.col("text").isin(*BOILERPLATE) & ~F.array_contains("kinds", "p"))
    return kept.join(best, key).where(F.array_contains("within", F.col("root"))).select(key, "pos", "text")


def archived(pages: DataFrame, key: str, body: str, least: int = 400) -> DataFrame:
    """The paragraphs of the block that directly holds most paragraph text, if it is least characters: key, pos, text, scene.
    Rules between them count scenes; credits of art are left out. Of equal blocks the first counts."""
    e = html.elements(pages, key, body, ["p"], ["div", "td", "article", "section", "hr"])
    e = e.where(~F.arrays_overlap("kinds", F.array(*map(F.lit, ["nav", "header", "footer", "form", "script", "style"])))).withColumn("block", F.try_element_at("within", F.lit(-1))).withColumn("around", F.try_element_at("kinds", F.lit(-1)))
    direct = e.where(F.col("around").isin("div", "td", "article", "section"))
    sizes = direct.where("tag = 'p'").groupBy(key, "block").agg(F.sum(F.length("text")).alias("size"))
    best = first_per_key(sizes, [key], [-F.col("size"), F.col("block")]).where(F.col("size") >= least).select(key, "block")
    w = Window.partitionBy(key).orderBy("pos")
    inside = direct.where("tag in ('p', 'hr')").join(best, [key, "block"]).withColumn("scene", F.sum((F.col("tag") == "hr").cast("int")).over(w).cast("int"))
    return inside.where((F.col("tag") == "p") & (F.col("text") != "") & ~F.col("text").rlike(r"(?i)(^|\|)\s*Art by\b")).select(key, "pos", "text", "scene")


def wiki(pages: DataFrame, key: str, body: str, longer: int = 20) -> DataFrame:
    """Paragraphs and list items of a wiki page, each under the heading it is in: key, pos, text, section, scene.

    Sections that are no story are left out whole, down to the next second-level heading; so are tables, figures and boxes.
    """
    e = html.elements(pages, key, body, ["h2", "h3", "h4", "p", "li"], classes=True)
    boxes = ("h2", "h3", "h4", "p", "li", "div", "table", "figure", "ul", "ol")
    boxed = F.exists(F.zip_with("kinds", "classes", lambda k, c: k.isin(*boxes) & c.rlike("toc|navbox|infobox")), lambda x: x)
    e = e.where(~F.arrays_overlap("kinds", F.array(F.lit("table"), F.lit("figure"))) & ~boxed)
    heading = F.when(F.col("tag").startswith("h"), F.trim(F.regexp_replace("text", r"\s*\[\s*edit\b.*$", "")))
    w = Window.partitionBy(key).orderBy("pos")
    carried = lambda c: F.last(c, ignorenulls=True).over(w)
    x = e.withColumn("_h", heading).withColumn("section", F.coalesce(carried("_h"), F.lit(""))).withColumn("_top", carried(F.when(F.col("tag") == "h2", F.col("_h"))))
    x = x.withColumn("scene", F.count("_h").over(w).cast("int"))
    lists = F.filter("kinds", lambda k: k.isin("ul", "ol", "li"))
    # A paragraph inside a list is its item's text; an item of a list within a list is its item's text, too.
    whole = F.when(F.col("tag") == "p", F.size(lists) == 0).otherwise(F.size(lists) == 1)
    kept = (F.col("_h").isNull()) & whole & ~F.coalesce(F.col("_top").rlike(f"(?i)^({WIKI_SKIP})$"), F.lit(False)) & (F.length("text") > longer)
    return x.where(kept).select(key, "pos", "text", "section", "scene")


#: Kinds of lines of a rule book, in the order they are tried: kind and pattern of number and text. Sections have three digits or more.
BOOK = {
    "chapter": r"^(\d)\. (.+)$",
    "section": r"^(\d{3,})\. (.+)$",
    "rule": r"^(\d{3,}\.\d+)\.? (.+)$",
    "subrule": r"^(\d{3,}\.\d+[a-z]+)\.? (.+)$",
    "example": r"^(Example): (.+)$",
}


def book(lines: DataFrame, key: str, pos: str, line: str) -> DataFrame:
    """A rule book's entries in order: key, pos, kind, number, text, chapter, section, rule, owner, problem.

    Every entry carries the numbers of the chapter, section and rule above it. An example's owner is the rule or subrule
    above it; any other line goes on with the entry above, after a line end. Lines with nothing above them to belong to have
    a problem.
    """
    x = lines.select(key, pos, F.trim(F.replace(line, F.lit("\u00a0"), F.lit(" "))).alias("_line")).where("_line <> ''")
    kind, number, text = F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("_line")
    for name, pattern in reversed(BOOK.items()):
        is_ = F.col("_line").rlike(pattern)
        kind, number, text = F.when(is_, name).otherwise(kind), F.when(is_, F.regexp_extract("_line", pattern, 1)).otherwise(number), F.when(is_, F.regexp_extract("_line", pattern, 2)).otherwise(text)
    w = Window.partitionBy(key).orderBy(pos)
    x = x.withColumn("kind", kind).withColumn("number", number).withColumn("_text", text)
    last = lambda value, *kinds: F.last(F.when(F.col("kind").isin(*kinds), value), ignorenulls=True).over(w)
    for name, above in (("chapter", None), ("section", "chapter"), ("rule", "section"), ("owner", "section")):
        kinds = ["rule", "subrule"] if name == "owner" else [name]
        valid = last(F.col(pos), *kinds) >= F.coalesce(F.greatest(*(last(F.col(pos), k) for k in ("chapter", "section"))), F.lit(-1)) if above == "section" else (last(F.col(pos), "section") >= F.coalesce(last(F.col(pos), "chapter"), F.lit(-1)) if above else F.lit(True))
        x = x.withColumn(name, F.when(valid, last(F.col("number"), *kinds)))
    x = x.withColumn("_entry", F.sum(F.col("kind").isNotNull().cast("int")).over(w))
    part = F.transform(F.array_sort(F.collect_list(F.struct(pos, "_text"))), lambda p: p["_text"])
    first = F.min_by(F.struct("kind", "number", "chapter", "section", "rule", "owner"), pos)
    out = x.groupBy(key, "_entry").agg(F.min(pos).alias(pos), first.alias("e"), F.array_join(part, "\n").alias("text")).select(key, pos, "e.*", "text")
    problem = F.when(F.col("kind").isNull(), "text before the first chapter").when((F.col("kind") == "section") & F.col("chapter").isNull(), "section before the first chapter")
    problem = problem.when((F.col("kind") == "rule") & F.col("section").isNull(), "rule before the first section").when((F.col("kind") == "subrule") & F.col("rule").isNull(), "subrule before the first rule")
    return out.withColumn("problem", problem.when((F.col("kind") == "example") & F.col("owner").isNull(), "example before the first rule"))


def glossary(lines: DataFrame, key: str, pos: str, line: str) -> DataFrame:
    """Entries of a glossary: a term, its definition on the lines below, then a blank line: key, pos, term, definition,
    problem (a term without a definition)."""
    w = Window.partitionBy(key).orderBy(pos)
    x = lines.select(key, pos, F.trim(F.replace(line, F.lit("\u00a0"), F.lit(" "))).alias("_line"))
    x = x.withColumn("_block", F.sum((F.col("_line") == "").cast("int")).over(w)).where("_line <> ''")
    part = F.transform(F.array_sort(F.collect_list(F.struct(pos, "_line"))), lambda p: p["_line"])
    out = x.groupBy(key, "_block").agg(F.min(pos).alias(pos), part.alias("_l"))
    return out.select(key, pos, F.get("_l", 0).alias("term"), F.array_join(F.slice("_l", 2, F.size("_l")), "\n").alias("definition"), F.when(F.size("_l") < 2, "no definition").alias("problem"))


def story_day(notes: Column, slug: Column, published: Column) -> Column:
    """When a story first came out: the day its first paragraphs (an array of texts) say, else the one at the end of its
    slug, else the day it was published."""
    said = F.filter(F.transform(notes, lambda t: F.nullif(F.regexp_extract(t, r"originally published on ([A-Z][a-z]+ \d{1,2}, \d{4})", 1), F.lit(""))), lambda t: t.isNotNull())
    days = F.filter(F.transform(said, lambda t: F.try_to_date(t, "MMMM d, yyyy")), lambda t: t.isNotNull())
    return F.coalesce(F.get(days, 0), F.try_to_date(F.nullif(F.regexp_extract(slug, r"-(\d{4}-\d{2}-\d{2})$", 1), F.lit(""))), F.try_to_date(F.left(published, F.lit(10))))
