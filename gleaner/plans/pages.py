"""Indexes, event pages, articles, wikis and rule books, over pages made of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.operators import pages
from gleaner.plans.registry import query
from gleaner.session import table


def _s(c: Column) -> Column:
    return c.cast("string")


def _spread(spark: SparkSession, d: str) -> DataFrame:
    """Parts dealt over the shuffle's partitions: their table is a few blocks, the pages made of it are many times larger."""
    return table(spark, d, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")


def _page(spark: SparkSession, d: str, *row: Column | str, head: str = "", tail: Column | str = "") -> DataFrame:
    """A page a brand, with a row of HTML for each of its parts in order."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    body = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", F.concat(*map(lit, row)).alias("h")))), lambda x: x["h"])
    dealt = table(spark, d, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_brand")  # few rows, large pages
    return dealt.groupBy("p_brand").agg(F.array_join(body, "\n").alias("h"), F.count(F.lit(1)).alias("n")).select("p_brand", F.concat(F.lit(head), "h", lit(tail)).alias("html"))


_HEAD = "CASE p_type WHEN 'PROMO' THEN 'frontier-cup' WHEN 'LARGE' THEN 'modern-challenge-32' WHEN 'SMALL' THEN 'modern-league' ELSE 'standard-super-qualifier' END"


@query(
    "month_index",
    f"""
WITH x AS (SELECT p_brand, p_partkey, p_name, p_type, p_size, {_HEAD} || '-2024-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') || (p_partkey % 50) AS slug FROM part WHERE p_size % 9 > 0 AND p_type <> 'PROMO'),
f AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY p_brand, slug ORDER BY p_partkey) = 1)
SELECT p_brand, CAST(p_partkey % 50 AS VARCHAR) AS event_id, slug, CASE p_type WHEN 'LARGE' THEN 'Challenge' WHEN 'SMALL' THEN 'Modern' ELSE 'Standard' END AS format,
  CASE WHEN p_size % 4 > 0 THEN p_name WHEN p_type = 'LARGE' THEN '32' WHEN p_type = 'SMALL' THEN 'League' ELSE 'Super Qualifier' END AS name, DATE '2024-01-01' + CAST(p_size % 28 AS INTEGER) AS day FROM f
""",
)
def month_index(spark: SparkSession, d: str) -> DataFrame:
    """Events of an index page by address, once each, with the longest format prefix; unknown formats are dropped."""
    head = F.when(F.col("p_type") == "PROMO", "frontier-cup").when(F.col("p_type") == "LARGE", "modern-challenge-32").when(F.col("p_type") == "SMALL", "modern-league").otherwise("standard-super-qualifier")
    slug = F.concat(head, F.lit("-2024-01-"), F.lpad(_s(1 + F.col("p_size") % 28), 2, "0"), _s(F.col("p_partkey") % 50))
    made = _page(
        spark, d, F.when(F.col("p_size") % 9 > 0, '<li class="decklists-item x">').otherwise("<li>"), '<a class="decklists-link" href="/decklist/', slug, '">',
        F.when(F.col("p_size") % 4 > 0, F.concat(F.lit("<div><h3> "), F.col("p_name"), F.lit("\n</h3></div>"))).otherwise("<b>no title</b>"), "</a></li>", head="<ul>", tail="</ul>",
    )
    formats = spark.createDataFrame([("modern", "Modern"), ("modern-challenge", "Challenge"), ("standard", "Standard")], "prefix string, format string")
    return pages.month_index(made, "p_brand", "html", formats).select("p_brand", "event_id", "slug", "format", "name", "day")


@query(
    "event_list",
    """
WITH f AS (SELECT * FROM part WHERE p_partkey % 7 > 0 QUALIFY row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) = 1), n AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
SELECT p_brand, CAST(p_size AS VARCHAR) AS event_id, p_name AS title, DATE '2024-03-01' + CAST(p_partkey % 28 AS INTEGER) AS day, n % 2 = 0 AS has_next FROM f JOIN n USING (p_brand)
""",
)
def event_list(spark: SparkSession, d: str) -> DataFrame:
    """Dated rows of a list, the first of each event, and whether there is a next page."""
    day = F.concat(F.lpad(_s(1 + F.col("p_partkey") % 28), 2, "0"), F.lit("/03/24"))
    made = _page(spark, d, '<tr><td><a href="event?e=', _s(F.col("p_size")), '&f=1">', F.col("p_name"), '</a></td><td class="S12">', F.when(F.col("p_partkey") % 7 > 0, day).otherwise("soon"), "</td></tr>", head="<table>", tail=F.when(F.col("n") % 2 == 0, '</table><a href="?cp=2">Next</a>').otherwise('<a href="?x">Next</a>'))
    return pages.event_list(made, "p_brand", "html")


@query(
    "event_placements",
    """SELECT p_brand, CAST(p_size AS VARCHAR) AS place, CAST(p_partkey AS VARCHAR) AS deck_id, p_name AS archetype, CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS VARCHAR) END AS family_id, p_type AS player FROM part WHERE p_partkey % 5 > 0 AND p_partkey % 7 > 0""",
)
def event_placements(spark: SparkSession, d: str) -> DataFrame:
    """Placed decks with archetype, player and family; places without a deck or player are left out."""
    made = _page(
        spark, d, '<div class="r"><div class="S14" style="', F.when(F.col("p_partkey") % 7 > 0, "width: 42px").otherwise("width:9px"), '">', _s(F.col("p_size")), '</div><div><a href="event?e=1&d=', _s(F.col("p_partkey")), '">', F.col("p_name"), "</a></div>",
        F.when(F.col("p_partkey") % 5 > 0, F.concat(F.lit('<a class="player" href="p">'), F.col("p_type"), F.lit("</a>"))).otherwise(""), F.when(F.col("p_size") % 3 > 0, F.concat(F.lit('<img src="/metas_thumbs/'), _s(F.col("p_size")), F.lit('.jpg">'))).otherwise('<img src="/x.png">'), "</div>",
    )
    return pages.placements(made, "p_brand", "html")


@query(
    "profile_paragraphs",
    """SELECT p_partkey, unnest(list_filter([CASE WHEN p_size % 5 = 0 THEN 'outside' END, p_brand, p_name || ' & more', CASE WHEN p_size % 2 = 0 THEN p_type END], lambda x: x IS NOT NULL)) AS text FROM part""",
)
def profile_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of a profile without boilerplate, from its article if it has one."""
    tag = lambda end: F.when(F.col("p_size") % 5 == 0, "").otherwise(end)
    body = F.concat(F.lit("<body><p>outside</p>"), tag("<article>"), F.lit("<h2>"), F.col("p_brand"), F.lit("</h2><p>EXPLORE THE LORE</p><p>"), F.col("p_name"), F.lit(" &amp;\n <b>more</b></p><div><p>"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(" "), F.lit("</p></div>"), tag("</article>"), F.lit("</body>"))
    return pages.profile(_spread(spark, d).select("p_partkey", body.alias("html")), "p_partkey", "html").select("p_partkey", "text")


@query(
    "archived_paragraphs",
    """
WITH s AS (SELECT *, length(p_name) + length(p_type) + 8 + length(p_brand) AS a FROM part)
SELECT p_partkey, unnest(CASE WHEN p_size > a THEN [{'text': repeat('y', p_size), 'scene': 0}] ELSE [{'text': p_name, 'scene': 0}, {'text': p_type, 'scene': 0}, {'text': p_brand, 'scene': 1}] END, recursive := true) FROM s WHERE greatest(p_size, a) >= 35
""",
)
def archived_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs of the block that directly holds most text, if that is enough."""
    body = F.concat(F.lit("<div><p>"), F.col("p_name"), F.lit("</p><p>"), F.col("p_type"), F.lit("</p><hr><p>Art by X</p><p>"), F.col("p_brand"), F.lit("</p></div><section><p>"), F.expr("repeat('y', p_size)"), F.lit("</p></section><nav><div><p>" + "z" * 900 + "</p></div></nav>"))
    return pages.archived(_spread(spark, d).select("p_partkey", body.alias("html")), "p_partkey", "html", least=35).select("p_partkey", "text", "scene")


@query(
    "wiki_paragraphs",
    """
SELECT p_partkey, unnest([{'text': 'An introduction of ' || p_name, 'section': '', 'scene': 0}, {'text': 'What happened to ' || p_name || ' then', 'section': 'History', 'scene': 1},
  {'text': 'A long list item of ' || p_name || ' with a nested one', 'section': 'History', 'scene': 1}, {'text': 'The last words on ' || p_name, 'section': 'Later', 'scene': 5}], recursive := true) FROM part
""",
)
def wiki_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs and items by section; skipped sections, tables, boxes, nested lists and short texts are left out."""
    body = F.concat(
        F.lit('<div class="mw-parser-output"><p>An introduction of '), F.col("p_name"), F.lit("</p><h2>History[edit]</h2><p>What happened to "), F.col("p_name"), F.lit(" then</p><ul><li>A long list item of "), F.col("p_name"),
        F.lit(" <ul><li>with a nested one</li></ul></li><li>short</li></ul><h3>Sub</h3><p>too short</p><h2>Trivia [ edit | edit source ]</h2><p>Never shown, though it is long</p><h3>In it</h3><p>Never shown either, in its part</p>"),
        F.lit('<h2>Later</h2><table><tr><td><p>This is in a table, long enough</p></td></tr></table><div class="infobox left"><p>This is in a box, long enough</p></div><p>The last words on '), F.col("p_name"), F.lit("</p></div>"),
    )
    return pages.wiki(_spread(spark, d).select("p_partkey", body.alias("html")), "p_partkey", "html").select("p_partkey", "text", "section", "scene")


_BOOK = """b AS (SELECT p_brand, p_partkey AS pos, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i, p_size % 7 AS t, p_name FROM part),
l AS (SELECT *, CASE t WHEN 0 THEN 'chapter' WHEN 1 THEN 'section' WHEN 2 THEN 'rule' WHEN 3 THEN 'subrule' WHEN 4 THEN 'example' WHEN 5 THEN 'rule' END AS kind,
  CASE t WHEN 0 THEN CAST(i % 10 AS VARCHAR) WHEN 1 THEN CAST(100 + i AS VARCHAR) WHEN 2 THEN '100.' || i WHEN 3 THEN '100.' || i || 'ab' WHEN 4 THEN 'Example' WHEN 5 THEN '606.' || i END AS number FROM b),
c AS (SELECT *, max(CASE WHEN t = 0 THEN pos END) OVER w AS pc, max(CASE WHEN t = 1 THEN pos END) OVER w AS ps, max(CASE WHEN t IN (2, 5) THEN pos END) OVER w AS pr, max(CASE WHEN t IN (2, 3, 5) THEN pos END) OVER w AS po, max(CASE WHEN kind IS NOT NULL THEN pos END) OVER w AS pe FROM l WINDOW w AS (PARTITION BY p_brand ORDER BY pos)),
g AS (SELECT p_brand, pe, min(pos) AS pos, string_agg(p_name, chr(10) ORDER BY pos) AS text FROM c GROUP BY 1, 2)"""


def _book_line() -> Column:
    from pyspark.sql import Window

    i = _s(F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")))
    n, t = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")), F.col("p_size") % 7
    out = F.when(t == 0, F.concat(_s(n % 10), F.lit(". "), F.col("p_name"))).when(t == 1, F.concat(_s(100 + n), F.lit(". "), F.col("p_name"))).when(t == 2, F.concat(F.lit("100."), i, F.lit(". "), F.col("p_name"))).when(t == 3, F.concat(F.lit("100."), i, F.lit("ab "), F.col("p_name")))
    return out.when(t == 4, F.concat(F.lit("Example: "), F.col("p_name"))).when(t == 5, F.concat(F.lit("606."), i, F.lit(" "), F.col("p_name"))).otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))


@query(
    "rule_book",
    f"""
WITH {_BOOK}, x AS (SELECT c.p_brand, c.pos, kind, number, g.text, CASE WHEN pc IS NOT NULL THEN pc END AS pc, CASE WHEN ps >= coalesce(pc, -1) THEN ps END AS ps, CASE WHEN pr >= greatest(coalesce(pc, -1), coalesce(ps, -1)) THEN pr END AS pr, CASE WHEN po >= greatest(coalesce(pc, -1), coalesce(ps, -1)) THEN po END AS po FROM c JOIN g USING (p_brand, pos))
SELECT p_brand, x.pos, kind, x.number, text, a.number AS chapter, b.number AS section, r.number AS rule, o.number AS owner,
  CASE WHEN kind IS NULL THEN 'text before the first chapter' WHEN kind = 'section' AND pc IS NULL THEN 'section before the first chapter' WHEN kind = 'rule' AND ps IS NULL THEN 'rule before the first section' WHEN kind = 'subrule' AND pr IS NULL THEN 'subrule before the first rule' WHEN kind = 'example' AND po IS NULL THEN 'example before the first rule' END AS problem
FROM x LEFT JOIN (SELECT pos, number FROM l) a ON a.pos = pc LEFT JOIN (SELECT pos, number FROM l) b ON b.pos = ps LEFT JOIN (SELECT pos, number FROM l) r ON r.pos = pr LEFT JOIN (SELECT pos, number FROM l) o ON o.pos = po
""",
)
def rule_book(spark: SparkSession, d: str) -> DataFrame:
    """A rule book's chapters, sections, rules, subrules and examples, lines that go on, and what has no place."""
    rows = table(spark, d, "part").select("p_brand", F.col("p_partkey").alias("pos"), _book_line().alias("line"))
    return pages.book(rows, "p_brand", "pos", "line")


@query(
    "glossary_entries",
    """
WITH b AS (SELECT p_brand, p_partkey AS pos, p_size % 4 = 0 AS blank, p_name FROM part), k AS (SELECT *, count(*) FILTER (blank) OVER (PARTITION BY p_brand ORDER BY pos) AS block FROM b)
SELECT p_brand, min(pos) AS pos, arg_min(p_name, pos) AS term, coalesce(array_to_string((list(p_name ORDER BY pos))[2:], chr(10)), '') AS definition, CASE WHEN count(*) < 2 THEN 'no definition' END AS problem FROM k WHERE NOT blank GROUP BY p_brand, block
""",
)
def glossary_entries(spark: SparkSession, d: str) -> DataFrame:
    """Glossary entries between blank lines; a term without a definition is a problem."""
    rows = table(spark, d, "part").select("p_brand", F.col("p_partkey").alias("pos"), F.when(F.col("p_size") % 4 == 0, " ").otherwise(F.col("p_name")).alias("line"))
    return pages.glossary(rows, "p_brand", "pos", "line")


@query(
    "story_days",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN DATE '2016-02-24' WHEN p_size % 3 = 1 THEN DATE '2019-05-01' + CAST(p_partkey % 20 AS INTEGER) WHEN p_size % 2 = 0 THEN DATE '2023-06-01' END AS day FROM part""",
)
def story_days(spark: SparkSession, d: str) -> DataFrame:
    """The day in a note, else in the slug, else of publication; days that do not exist don't count."""
    notes = F.array(F.col("p_name"), F.when(F.col("p_size") % 3 == 0, "Editor's Note: This story was originally published on February 24, 2016.").otherwise("It was originally published on Smarch 40, 2016."))
    slug = F.when(F.col("p_size") % 3 == 1, F.concat(F.lit("the-"), _s(F.col("p_size")), F.lit("-2019-05-"), F.lpad(_s(1 + F.col("p_partkey") % 20), 2, "0"))).otherwise(F.concat(F.col("p_name"), F.lit("-2019-99-99")))
    return table(spark, d, "part").select("p_partkey", pages.story_day(notes, slug, F.when(F.col("p_size") % 2 == 0, "2023-06-01T10:00:00Z").otherwise("unknown")).alias("day"))
