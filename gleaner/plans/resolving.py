"""Chains of fallbacks, duplicates, spreads and carried answers over the bound tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.operators import resolving
from gleaner.plans.bindings import CATALOG, DECKS, LINES, catalog, decks, lines
from gleaner.plans.registry import query
from gleaner.session import table
from gleaner.sources import sinks


def _part(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))


def _s(c: str) -> Column:
    return F.col(c).cast("string")


@query(
    "repeated_pages",
    """
WITH p AS (SELECT p_partkey AS k, p_size, CASE p_partkey % 3 WHEN 0 THEN 'story' WHEN 1 THEN 'archive' ELSE 'profile' END AS kind, p_name AS title, p_type AS body,
  CASE p_partkey % 3 WHEN 1 THEN p_name || '-20' || lpad(CAST(10 + p_size % 12 AS VARCHAR), 2, '0') || '-01-01' || CASE WHEN p_size % 2 = 0 THEN '-' || p_partkey ELSE '' END WHEN 2 THEN p_name || '/' || p_partkey // 6 || CASE WHEN p_partkey % 2 = 0 THEN '-0' ELSE '' END ELSE 's' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS key FROM part),
u AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY key ORDER BY k) = 1),
s AS (SELECT key FROM u WHERE kind = 'story' QUALIFY row_number() OVER (PARTITION BY title, body ORDER BY key) > 1),
a AS (SELECT key FROM u WHERE kind = 'archive' QUALIFY row_number() OVER (PARTITION BY title ORDER BY p_size % 12, key) > 1)
SELECT key FROM s UNION SELECT key FROM a UNION SELECT x.key FROM u x JOIN u y ON x.key = y.key || '-0' AND x.title = y.title
""",
)
def repeated_pages(spark: SparkSession, d: str) -> DataFrame:
    """Stories with the same body, columns under several dates, and copies marked as uploaded again."""
    from gleaner.operators.priority import first_per_key

    k, size = F.col("k"), F.col("size")
    day = F.concat(F.lit("-20"), F.lpad((10 + size % 12).cast("string"), 2, "0"), F.lit("-01-01"), F.when(size % 2 == 0, F.concat(F.lit("-"), _s("k"))).otherwise(""))
    key = F.when(k % 3 == 1, F.concat("name", day)).when(k % 3 == 2, F.concat("name", F.lit("/"), F.expr("cast(k div 6 as string)"), F.when(k % 2 == 0, "-0").otherwise(""))).otherwise(F.concat(F.lit("s"), F.lpad(_s("k"), 9, "0")))
    kind = F.when(k % 3 == 0, "story").when(k % 3 == 1, "archive").otherwise("profile")
    pages = _part(spark, d).select("k", key.alias("key"), kind.alias("kind"), F.concat(F.lit(" "), F.initcap("name")).alias("title"), F.array(_s("k"), F.col("type"), F.lit("end")).alias("paragraphs"))
    return resolving.duplicate_pages(first_per_key(pages, ["key"], [F.col("k")]).drop("k"))


@query(
    "reminder_texts",
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'Pay ' || p_size WHEN 1 THEN 'It flies' WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN 'second line' ELSE '' END AS reminder FROM part""",
)
def reminder_texts(spark: SparkSession, d: str) -> DataFrame:
    """The reminder that follows a keyword with a few words between, on any line."""
    k = F.col("size") % 6
    text = F.when(k == 0, F.concat(F.lit("Kicker {1}{R} (Pay "), _s("size"), F.lit(")"))).when(k == 1, "Haste\nMultikicker (not this)\nkicker. (It flies)").when(k == 2, F.concat(F.lit("Kicker "), F.lit("a very long line of words " * 4), F.lit("(too far)")))
    text = text.when(k == 3, "Kicker. Then more. (after a sentence)").when(k == 4, "Kicker\n(not on this line)\nKICKER (second line) (third)").otherwise("Kickers (no) kicker () none")
    return _part(spark, d).select(F.col("k").alias("p_partkey"), resolving.reminder(F.lit("kicker"), text).alias("reminder"))


@query(
    "era_days",
    """
WITH e AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN ' ' || upper(p_brand) WHEN 1 THEN CAST(1985 + p_size AS VARCHAR) WHEN 2 THEN 'brand#99' WHEN 3 THEN NULL ELSE lower(p_brand) END AS era, p_brand, p_size FROM part), s AS (SELECT p_brand, max(p_size) AS m FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN p_size % 5 IN (0, 4) AND m % 3 > 0 THEN 'Set ' || e.p_brand WHEN p_size % 5 = 1 AND 1985 + p_size BETWEEN 1993 AND 2029 THEN era END AS era_label, CASE WHEN p_size % 5 IN (0, 4) AND m % 3 > 0 THEN DATE '2020-01-01' + CAST(m AS INTEGER) WHEN p_size % 5 = 1 AND 1985 + p_size BETWEEN 1993 AND 2029 THEN CAST(era || '-07-01' AS DATE) END AS era_day FROM e JOIN s USING (p_brand)
""",
)
def era_days(spark: SparkSession, d: str) -> DataFrame:
    """An era's day by the code of a set, else the first of July of a year."""
    k, part = F.col("size") % 5, _part(spark, d)
    events = part.select(F.col("k").alias("p_partkey"), F.when(k == 0, F.concat(F.lit(" "), F.upper("brand"))).when(k == 1, (1985 + F.col("size")).cast("string")).when(k == 2, "brand#99").when(k == 4, F.lower("brand")).alias("era"))
    sets = part.groupBy("brand").agg(F.max("size").alias("m")).select(F.lower("brand").alias("code"), F.concat(F.lit("Set "), "brand").alias("label"), F.when(F.col("m") % 3 > 0, F.date_add(F.lit("2020-01-01").cast("date"), F.col("m").cast("int"))).alias("day"))
    return resolving.era(sets, events, "era").select("p_partkey", "era_label", "era_day")


@query(
    "event_sets",
    """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN CASE WHEN p_brand LIKE '%1' THEN p_brand END WHEN p_size % 5 = 1 THEN p_brand WHEN p_size % 3 = 0 THEN 'line ' || p_type WHEN p_size % 2 = 0 THEN 'day ' || p_size % 4 END AS "set" FROM part
""",
)
def event_sets(spark: SparkSession, d: str) -> DataFrame:
    """An event's set by the page of cards, else the era, else the storyline, else the day."""
    size, part = F.col("size"), _part(spark, d)
    events = part.select(
        F.col("k").alias("p_partkey"), F.when(size % 5 == 0, F.concat(F.lit("cards/"), "brand")).otherwise("stories/x").alias("page"), F.when(size % 5 == 1, F.col("brand")).otherwise("1999").alias("era"),
        F.when(size % 3 == 0, F.col("type")).otherwise("no storyline").alias("storyline"), F.when(size % 2 == 0, size % 4).alias("day"),
    )
    codes = part.select(F.col("brand").alias("code")).distinct()
    lines_ = part.select(F.col("type").alias("storyline"), F.concat(F.lit("line "), "type").alias("code")).distinct()
    days = part.select((size % 4).alias("day")).distinct().withColumn("code", F.concat(F.lit("day "), _s("day")))
    return resolving.event_sets(events, codes.where("code like '%1'"), codes, lines_, days).select("p_partkey", "set")


@query(
    "shown_types",
    """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN CASE WHEN p_partkey % 3 = 0 OR p_partkey % 4 = 0 THEN 'planeswalker' ELSE 'character' END WHEN 1 THEN 'plane' WHEN 2 THEN NULL WHEN 3 THEN CASE WHEN p_partkey % 3 = 0 OR p_partkey % 4 = 0 THEN 'planeswalker' ELSE 'character' END ELSE 'artifact' END AS type FROM part""",
)
def shown_types(spark: SparkSession, d: str) -> DataFrame:
    """The type an entity is shown as."""
    kind = F.element_at(F.array(*map(F.lit, ["character", "plane", "event", "deity", "artifact"])), (F.col("size") % 5 + 1).cast("int"))
    said = F.when(F.col("k") % 4 == 0, "A Planeswalker of old.").when(F.col("k") % 2 == 0, "")
    return _part(spark, d).select(F.col("k").alias("p_partkey"), resolving.shown_type(kind, said, F.col("k") % 3 == 0).alias("type"))


@query("land_targets", """SELECT p_partkey, 36 - CASE WHEN p_size % 20 >= 12 THEN 1 ELSE 0 END + CASE WHEN p_size / 10.0 > 3.5 THEN 1 ELSE 0 END AS lands FROM part""")
def land_targets(spark: SparkSession, d: str) -> DataFrame:
    """Lands of a list by its ramp and its average mana value."""
    return _part(spark, d).select(F.col("k").alias("p_partkey"), resolving.land_target(F.col("size") % 20, F.col("size") / 10.0).alias("lands"))


@query(
    "looked_up_names",
    f"""
WITH {CATALOG}, c AS (SELECT slug, CASE WHEN color % 5 < 4 THEN ['W', 'U', 'B', 'R', 'G'][color + 1] END AS colors FROM catalog WHERE slug NOT LIKE '%ring'),
n AS (SELECT p_partkey, p_name AS a, lag(p_name) OVER (ORDER BY p_partkey) AS b, p_size FROM part), x AS (SELECT p_partkey, replace(a, ' ', '-') AS s, CASE WHEN p_size % 2 = 0 AND b IS NOT NULL THEN replace(b, ' ', '-') END AS t FROM n)
SELECT p_partkey, CASE WHEN t IS NULL THEN u.colors WHEN u.colors IS NOT NULL AND v.colors IS NOT NULL THEN array_to_string(list_filter(['W', 'U', 'B', 'R', 'G'], lambda q: q IN (u.colors, v.colors)), '') END AS colors, CASE WHEN t IS NULL THEN u.slug END AS oracle_id FROM x LEFT JOIN c u ON u.slug = s LEFT JOIN c v ON v.slug = t
""",
)
def looked_up_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in the catalog, and the colours of both halves of one that it lacks."""
    part, wheel = _part(spark, d), F.array(*map(F.lit, "WUBRG"))
    before = part.select((F.col("k") + 1).alias("k"), F.col("name").alias("b"))
    names = part.join(before, "k", "left").select(F.col("k").alias("p_partkey"), F.when((F.col("size") % 2 == 0) & F.col("b").isNotNull(), F.concat("name", F.lit(" // "), "b")).otherwise(F.col("name")).alias("name"))
    known = catalog(spark, d).where("slug not like '%ring'").select("slug", F.when(F.col("color") < 4, F.array(F.element_at(wheel, F.col("color") + 1))).alias("colors"), F.col("slug").alias("oracle_id"))
    return resolving.looked_up(names, known, "name").select("p_partkey", F.array_join("colors", "").alias("colors"), "oracle_id")


@query(
    "picked_events",
    """
WITH e AS (SELECT p_brand AS g, p_partkey AS pos, p_size % 3 > 0 AS story, p_size % 4 = 0 AS major FROM part), a AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (story) OVER w AS own FROM e WINDOW w AS (PARTITION BY g)),
p AS (SELECT * FROM a WHERE n <= 5 OR own < 5 OR story), m AS (SELECT *, count(*) FILTER (major) OVER (PARTITION BY g) AS majors, count(*) OVER (PARTITION BY g, major) AS c, row_number() OVER (PARTITION BY g, major ORDER BY pos) - 1 AS i FROM p),
w AS (SELECT *, CASE WHEN major THEN least(majors, 5) ELSE greatest(5 - majors, 0) END AS k FROM m)
SELECT g, pos FROM w WHERE n <= 5 OR c <= k OR (k = 1 AND i = 0) OR (k > 1 AND list_contains([CAST(round_even(j * (c - 1) / (k - 1), 0) AS BIGINT) FOR j IN range(k)], i))
""",
)
def picked_events(spark: SparkSession, d: str) -> DataFrame:
    """Five events of each arc: its own first, major ones first, spread from beginning to end."""
    events = _part(spark, d).select(F.col("brand").alias("g"), F.col("k").alias("pos"), (F.col("size") % 3 > 0).alias("story"), (F.col("size") % 4 == 0).alias("major"))
    return resolving.picked(events, "g", "pos", 5).select("g", "pos")


@query(
    "ranked_pages",
    """
WITH r AS (SELECT p_partkey AS k, p_size, unnest([p_brand || 'x', CASE WHEN p_size % 3 > 0 THEN p_name ELSE 'none' END, p_type || '/' || p_brand]) AS slug, unnest([1, 2, 3]) AS i FROM part), g AS (SELECT DISTINCT p_name AS slug FROM part WHERE p_size % 2 = 0 UNION SELECT DISTINCT p_type || '/' || p_brand FROM part WHERE p_size % 5 = 0),
b AS (SELECT k, p_size, slug FROM r JOIN g USING (slug) QUALIFY row_number() OVER (PARTITION BY k ORDER BY i) = 1), u AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY slug ORDER BY p_size DESC, k) = 1)
SELECT CAST(row_number() OVER (ORDER BY p_size DESC, k) AS INTEGER) AS rank, k, slug FROM u QUALIFY row_number() OVER (ORDER BY p_size DESC, k) <= 50
""",
)
def ranked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Rows matched to the first of their candidates that is a page, each page once, fifty at most in source order."""
    part = _part(spark, d)
    wide = F.concat("type", F.lit("/"), "brand")
    rows = part.select("k", "size", F.array(F.concat("brand", F.lit("x")), F.when(F.col("size") % 3 > 0, F.col("name")).otherwise("none"), wide).alias("c"))
    pages = part.where("size % 2 = 0").select(F.col("name").alias("slug")).union(part.where("size % 5 = 0").select(wide)).distinct()
    return resolving.first_existing(rows, pages, "k", "c", [-F.col("size"), F.col("k")], 50).select("rank", "k", "slug")


@query(
    "filled_ids",
    f"""WITH {CATALOG} SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'own' ELSE catalog.name END AS id FROM part LEFT JOIN catalog ON slug = replace(p_name, ' ', '-') AND slug NOT LIKE '%ring'""",
)
def filled_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids filled in by name, only where they are missing."""
    rows = _part(spark, d).select(F.col("k").alias("p_partkey"), "name", F.when(F.col("size") % 2 == 0, "own").alias("id"))
    return resolving.filled_ids(rows, catalog(spark, d).where("slug not like '%ring'").select("slug", F.col("name").alias("id")), "name", "id")[0].select("p_partkey", "id")


@query(
    "unknown_names",
    """SELECT DISTINCT p_name AS name FROM part WHERE p_size % 2 > 0 AND p_name LIKE '%ring'""",
)
def unknown_names(spark: SparkSession, d: str) -> DataFrame:
    """The names that the catalog lacks, once each."""
    rows = _part(spark, d).select(F.col("k").alias("p_partkey"), "name", F.when(F.col("size") % 2 == 0, "own").alias("id"))
    return resolving.filled_ids(rows, catalog(spark, d).where("slug not like '%ring'").select("slug", F.col("name").alias("id")), "name", "id")[1]


@query(
    "carried_answers",
    """
WITH o AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 2), n AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size < 49), x AS (SELECT coalesce(o.p_brand, n.p_brand) AS b FROM o FULL JOIN n ON o.p_brand = n.p_brand AND o.p_type = n.p_type WHERE o.p_brand IS NULL OR n.p_brand IS NULL)
SELECT p_brand, p_type, 'answer ' || p_type AS answer FROM o WHERE p_brand NOT IN (SELECT b FROM x)
""",
)
def carried_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers are carried over only where the keys of both runs are the same."""
    part = table(spark, d, "part")
    old = part.where("p_size > 2").select("p_brand", "p_type", F.concat(F.lit("answer "), "p_type").alias("answer")).distinct()
    return resolving.carried_over(old, part.where("p_size < 49").select("p_brand", "p_type"), "p_brand", ["p_type"])


@query(
    "alias_edges",
    """
WITH n AS (SELECT p_partkey AS page, p_name AS name, CASE p_size % 4 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN p_brand WHEN 2 THEN p_type || ' only ' || p_name ELSE p_name END AS alias FROM part UNION ALL SELECT p_partkey + 1000000000, split_part(p_name, ' ', 1), '' FROM part WHERE p_size % 9 = 0),
g AS (SELECT name, count(DISTINCT page) AS pages FROM n GROUP BY 1), p AS (SELECT DISTINCT name, alias FROM n WHERE alias <> '' AND alias <> name), o AS (SELECT alias, count(*) AS owners FROM p GROUP BY 1),
x AS (SELECT p.name, p.alias, owners, t.name IS NOT NULL AS taken, g.pages, p.alias = split_part(p.name, ' ', 1) AS short FROM p JOIN o USING (alias) LEFT JOIN g t ON t.name = p.alias JOIN g ON g.name = p.name)
SELECT name, alias FROM x WHERE owners = 1 AND (NOT taken OR short) UNION ALL SELECT name, alias FROM x WHERE owners > 1 AND taken AND short QUALIFY row_number() OVER (PARTITION BY alias ORDER BY pages DESC, name DESC) = 1
""",
)
def alias_edges(spark: SparkSession, d: str) -> DataFrame:
    """Aliases of one name join it; one of several goes to the longer name that is on most pages."""
    k, first = F.col("size") % 4, F.split_part("name", F.lit(" "), F.lit(1))
    named = _part(spark, d).select(F.col("k").alias("page"), "name", F.when(k == 0, first).when(k == 1, F.col("brand")).when(k == 2, F.concat("type", F.lit(" only "), "name")).otherwise(F.col("name")).alias("alias"))
    alone = _part(spark, d).where("size % 9 = 0").select((F.col("k") + 1000000000).alias("page"), first.alias("name"), F.lit("").alias("alias"))
    return resolving.alias_edges(named.union(alone))


@query(
    "matchup_blocks",
    """SELECT p_partkey, block, CASE block WHEN 1 THEN p_name ELSE 'Other' END AS name, CASE block WHEN 1 THEN p_brand END AS archetype, CASE block WHEN 1 THEN '2 ' || p_type || ',1 Plate' ELSE '' END AS "in", CASE block WHEN 1 THEN '' ELSE p_size || ' Bolt' END AS out FROM part, (VALUES (1), (2)) v(block)""",
)
def matchup_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The matchup blocks of primers with the cards to bring in and take out."""
    text = F.concat(F.lit('# A\nIn: 9 [[Before]]\n:::matchup "'), F.col("name"), F.lit('" archetype='), F.col("brand"), F.lit(" x\nin: 2 [["), F.col("type"), F.lit("|t]], 1 [[ Plate ]]\nsaid\n:::\nout: 3 [[Between]]\n:::matchup \"Other\"\r\nOUT: "), _s("size"), F.lit(" [[Bolt]]\n:::"))
    out = resolving.matchups(_part(spark, d).select(F.col("k").alias("p_partkey"), text.alias("text")), "p_partkey", "text")
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(" ", x["quantity"].cast("string"), x["name"])), ",")
    return out.select("p_partkey", F.col("block").cast("int").alias("block"), "name", "archetype", told("in").alias("in"), told("out").alias("out"))


@query(
    "published_index",
    """SELECT o_orderpriority AS "group", count(*) AS files, CAST(sum(length('{"id":' || o_orderkey || '}')) AS BIGINT) AS bytes, min(sha256('{"id":' || o_orderkey || '}')) AS first_sha256 FROM orders GROUP BY 1""",
)
def published_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of published files with checksums, bytes and counts."""
    docs = sinks.documents(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id").join(table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("key"), "o_orderpriority"), "key")
    return docs.groupBy(F.col("o_orderpriority").alias("group")).agg(F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("body")).alias("bytes"), F.min(F.sha2("body", 256)).alias("first_sha256"))


@query(
    "listed_shares",
    f"""WITH {DECKS}, c AS (SELECT format, archetype, count(*) AS decks FROM decks WHERE place < 3 GROUP BY 1, 2), l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY format ORDER BY decks DESC, archetype) <= 3) SELECT format, archetype, decks, round(decks * 100.0 / sum(decks) OVER (PARTITION BY format), 1) AS share FROM l""",
)
def listed_shares(spark: SparkSession, d: str) -> DataFrame:
    """Each listed archetype's share of the decks of those that are listed."""
    from pyspark.sql import Window

    from gleaner.operators.priority import top_per_group

    counts = decks(spark, d).where("place < 3").groupBy("format", "archetype").agg(F.count(F.lit(1)).alias("decks"))
    listed = top_per_group(counts, ["format"], [F.desc("decks"), F.col("archetype")], 3)
    return listed.select("format", "archetype", "decks", F.round(F.col("decks") * 100.0 / F.sum("decks").over(Window.partitionBy("format")), 1).alias("share"))


@query("facts_per_page", """SELECT user_id AS page, count(*) FILTER (event_type = 'view') AS events, count(*) FILTER (event_type = 'click') AS relations, count(*) FILTER (event_type IN ('view', 'click')) AS facts FROM events GROUP BY 1""")
def facts_per_page(spark: SparkSession, d: str) -> DataFrame:
    """The facts of each page by kind."""
    kind = F.col("event_type")
    return table(spark, d, "events").groupBy(F.col("user_id").alias("page")).agg(F.count_if(kind == "view").alias("events"), F.count_if(kind == "click").alias("relations"), F.count_if(kind.isin("view", "click")).alias("facts"))


@query(
    "deck_prices",
    f"""WITH {LINES}, {CATALOG} SELECT deck_id, round(sum(qty * coalesce(CASE WHEN slug LIKE '%plate' THEN 0.05 ELSE price END, 0)), 2) AS price, count(*) FILTER (c.slug IS NULL OR price > 1400 AND slug NOT LIKE '%plate') AS unpriced FROM lines LEFT JOIN (SELECT slug, CASE WHEN price <= 1400 THEN price END AS price FROM catalog) c USING (slug) GROUP BY 1""".replace("c.slug IS NULL OR price > 1400 AND slug NOT LIKE '%plate'", "price IS NULL AND slug NOT LIKE '%plate'"),
)
def deck_prices(spark: SparkSession, d: str) -> DataFrame:
    """The price of a list with its basics; cards without a price count nothing and are counted."""
    known = catalog(spark, d).select("slug", F.when(F.col("price") <= 1400, F.col("price")).alias("price"))
    each = F.when(F.col("slug").endswith("plate"), F.lit(0.05)).otherwise(F.col("price"))
    x = lines(spark, d).join(known, "slug", "left").withColumn("each", each)
    return x.groupBy("deck_id").agg(F.round(F.sum(F.col("qty") * F.coalesce("each", F.lit(0.0))), 2).alias("price"), F.count_if(F.col("each").isNull()).alias("unpriced"))


@query(
    "list_colors",
    f"""
WITH {DECKS}, {LINES}, {CATALOG}, l AS (SELECT deck_id, list_distinct(list(['W', 'U', 'B', 'R', 'G'][color + 1])) AS found FROM lines JOIN catalog USING (slug) WHERE board = 'main' GROUP BY 1)
SELECT deck_id, CASE WHEN place = 1 THEN 'WU' ELSE array_to_string(list_filter(['W', 'U', 'B', 'R', 'G'], lambda c: list_contains(found, c)), '') END AS colors FROM decks LEFT JOIN l USING (deck_id)
""",
)
def list_colors(spark: SparkSession, d: str) -> DataFrame:
    """A deck's colours as its event gave them, else those of its list, in order."""
    wheel = F.array(*map(F.lit, "WUBRG"))
    found = lines(spark, d).where("board = 'main'").join(catalog(spark, d).select("slug", "color"), "slug").groupBy("deck_id").agg(F.collect_set(F.element_at(wheel, F.col("color") + 1)).alias("found"))
    x = decks(spark, d).select("deck_id", "place").join(found, "deck_id", "left")
    return x.select("deck_id", F.when(F.col("place") == 1, "WU").otherwise(F.array_join(F.filter(wheel, lambda c: F.array_contains("found", c)), "")).alias("colors"))


@query(
    "lore_catalog",
    """
WITH p AS (SELECT p_name, p_brand, min(CASE WHEN p_size % 6 > 0 THEN 1990 + p_size END) AS y, count(*) FILTER (p_type <> 'PROMO') AS n FROM part WHERE p_partkey % 5 > 0 GROUP BY 1, 2), s AS (SELECT p_name, p_brand, coalesce(CAST(y AS VARCHAR), '9999') AS y FROM p WHERE n > 0)
SELECT c.p_name AS name, coalesce(string_agg(p_brand, ',' ORDER BY y, p_brand), '') AS sets, coalesce(min(y), '') AS first_printed FROM (SELECT DISTINCT p_name FROM part WHERE p_partkey % 5 > 0) c LEFT JOIN s USING (p_name) GROUP BY 1
""",
)
def lore_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Each card once, with the sets it was printed in by release, and when first; sets without stories don't count."""
    rows = _part(spark, d).where("k % 5 > 0")
    day = F.when(F.col("size") % 6 > 0, (1990 + F.col("size")).cast("string")).otherwise("9999")
    sets = rows.where("name is not null").groupBy("name", "brand").agg(F.min(day).alias("y"), F.count_if(F.col("type") != "PROMO").alias("n")).where("n > 0")
    listed = sets.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("y", "brand"))).alias("s"))
    return rows.select("name").distinct().join(listed, "name", "left").select("name", F.coalesce(F.array_join(F.transform("s", lambda x: x["brand"]), ","), F.lit("")).alias("sets"), F.coalesce(F.get("s", 0)["y"], F.lit("")).alias("first_printed"))


@query(
    "reference_decks",
    f"""WITH {DECKS}, {LINES}, d AS (SELECT deck_id, archetype, ts FROM decks WHERE ts >= TIMESTAMP '1998-06-01' AND archetype <> 'NATION_7') SELECT deck_id, archetype, CAST(row_number() OVER (PARTITION BY archetype ORDER BY ts DESC, deck_id) AS INTEGER) AS position FROM d WHERE deck_id IN (SELECT deck_id FROM lines)""",
)
def reference_decks(spark: SparkSession, d: str) -> DataFrame:
    """Stored decks since a cutoff, newest first: those that are named and have a list."""
    from pyspark.sql import Window

    rows = decks(spark, d).where("ts >= '1998-06-01' and archetype <> 'NATION_7'").select("deck_id", "archetype", "ts")
    listed = rows.join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("deck_id")), "deck_id", "left_semi")
    w = Window.partitionBy("archetype").orderBy(F.desc("ts"), "deck_id")
    return listed.select("deck_id", "archetype", F.row_number().over(w).alias("position"))
