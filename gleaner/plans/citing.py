"""Citations, links and sentences of the bound pages, and the first tagged cards of customers' pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.operators import citing
from gleaner.plans.pagejson import _N, _pages
from gleaner.plans.registry import query
from gleaner.session import table
from gleaner.sources import pagejson

#: Keys of URLs and the columns that they name.
COLUMNS = {"fr": "French column", "de": "German column", "en": "English column"}


@query(
    "page_citations",
    """
WITH x AS (SELECT page_id AS k, url, 'Page ' || page_id || CASE WHEN page_id % 4 = 3 THEN ' | Plane' ELSE '' END AS title, page_id % 3 AS s, page_id % 2 = 0 AS story FROM pages),
c AS (SELECT *, CASE WHEN regexp_matches(lower(url), '[/=]fr(/|-[0-9]{4}|$)') THEN 'French column' WHEN regexp_matches(lower(url), '[/=]de(/|-[0-9]{4}|$)') THEN 'German column' WHEN regexp_matches(lower(url), '[/=]en(/|-[0-9]{4}|$)') THEN 'English column' ELSE 'archive' END AS col FROM x)
SELECT k AS page_id, CASE WHEN s = 2 AND NOT story THEN regexp_replace(title, ' \\| Plane$', '') ELSE title END AS work, CASE s WHEN 0 THEN 'Wiki' WHEN 1 THEN col ELSE CASE WHEN story THEN 'Stories' ELSE 'Profiles' END END AS series, s <> 0 AS official,
  CASE WHEN s = 1 AND k % 5 > 0 THEN 'old/' || k ELSE url END AS link, CASE WHEN s = 0 THEN CASE WHEN k % 2 = 0 THEN 'CC BY 4.0' ELSE 'CC BY-NC-SA 4.0' END END AS license,
  CASE s WHEN 0 THEN '"' || title || '"' || CASE WHEN k % 7 = 0 THEN ', section "S"' ELSE '' END || '. Wiki contributors, ' || CASE WHEN k % 2 = 0 THEN 'CC BY 4.0' ELSE 'CC BY-NC-SA 4.0' END || '.'
    WHEN 1 THEN '"' || title || '". ' || col || ', Publisher' || CASE WHEN k % 4 > 0 THEN ', 2024' ELSE '' END || '. Archived.'
    ELSE '"' || CASE WHEN NOT story THEN regexp_replace(title, ' \\| Plane$', '') ELSE title END || '"' || CASE WHEN k % 3 = 2 AND k % 8 > 3 THEN ' by A, B' ELSE '' END || '. ' || CASE WHEN story THEN 'Stories' ELSE 'Profiles' END || ', Publisher' || CASE WHEN k % 4 > 0 THEN ', 2024' ELSE '' END || '.' END AS text
FROM c
""",
)
def page_citations(spark: SparkSession, d: str) -> DataFrame:
    """The citation of each page by its source, with licence, archived copy and the column that its URL names."""
    k = F.col("page_id")
    title = F.concat(F.lit("Page "), k.cast("string"), F.when(k % 4 == 3, " | Plane").otherwise(""))
    source = F.when(k % 3 == 0, "wiki").when(k % 3 == 1, "archive").otherwise("publisher")
    authors = F.when(k % 8 > 3, F.array(F.lit("A"), F.lit("B")))
    x = citing.citation(source, F.when(k % 2 == 0, "story").otherwise("profile"), title, F.col("url"), F.when(k % 5 > 0, F.concat(F.lit("old/"), k.cast("string"))), authors, F.when(k % 4 > 0, "2024"), F.when(k % 7 == 0, "S"), F.when(k % 2 == 0, "CC BY 4.0, contributors"), COLUMNS)
    return table(spark, d, "pages").select("page_id", x.alias("c")).select("page_id", "c.work", "c.series", "c.official", "c.link", "c.license", "c.text")


@query(
    "listing_links",
    """
WITH x AS (SELECT page_id, list_distinct(regexp_extract_all(html, 'href="(/[^"#?]+)"', 1)) AS l FROM pages) SELECT page_id, len(l) AS links, array_to_string(list_sort(l), ' ') AS paths, CASE WHEN page_id % 3 > 0 THEN page_id * 7 END AS total FROM x
""",
)
def listing_links(spark: SparkSession, d: str) -> DataFrame:
    """The paths that a listing links to, and how many entries it says that there are."""
    html = F.concat("html", F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("<script>x={totalRows:"), (F.col("page_id") * 7).cast("string"), F.lit("}</script>"))).otherwise(""))
    x = table(spark, d, "pages").select("page_id", citing.listed_paths(html, "/").alias("l"), citing.told_total(html).alias("total"))
    return x.select("page_id", F.size("l").cast("bigint").alias("links"), F.array_join(F.array_sort("l"), " ").alias("paths"), "total")


@query(
    "chosen_links",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://media.example.com/a/Rules%20' || page_id || '.txt' WHEN 1 THEN 'https://media.example.com/CompRules' || page_id || '.TXT?x=1' WHEN 2 THEN 'https://media.example.com/first.txt' END AS link FROM pages""",
)
def chosen_links(spark: SparkSession, d: str) -> DataFrame:
    """The link to the text file on the right host, the one named like it first."""
    k, kind = F.col("page_id").cast("string"), F.col("page_id") % 4
    host = "https://media.example.com"
    anchors = F.when(kind == 0, F.array(F.lit("https://other.example.com/a.txt"), F.concat(F.lit(f" {host}/a/Rules "), k, F.lit(".txt")))).when(kind == 1, F.array(F.lit(f"{host}/first.txt"), F.concat(F.lit(f"{host}/CompRules"), k, F.lit(".TXT?x=1"))))
    anchors = anchors.when(kind == 2, F.array(F.lit(f"{host}/a.pdf"), F.lit(f"{host}/first.txt"), F.lit(f"{host}/second.txt"))).otherwise(F.array(F.lit(f"{host}/comprules.html?x=.txt"), F.lit("https://media.example.com.evil.org/comprules.txt")))
    return table(spark, d, "pages").select("page_id", citing.chosen_link(anchors, "media.example.com", ".txt", "comprules").alias("link"))


@query(
    "tagged_cards",
    f"""
WITH {_N}, o AS (SELECT o_custkey, o_orderkey AS k, left(o_orderpriority, 1) AS level, o_orderstatus AS s FROM orders),
g AS (SELECT c_custkey, level, k, row_number() OVER (PARTITION BY c_custkey, level ORDER BY k) - 1 AS pos, CASE WHEN k % 2 = 0 THEN k % 100 + 1 WHEN seg <> 'AUTOMOBILE' THEN decks END AS of_decks FROM o JOIN n ON o_custkey = c_custkey WHERE seg <> 'MACHINERY' AND s NOT IN ('P', 'O') AND level IN ('4', '2')),
b AS (SELECT c_custkey, max(level) AS level FROM g GROUP BY 1)
SELECT c_custkey, CAST(pos AS INTEGER) AS pos, 'card ' || k AS name, round((k % 50) * 100 / of_decks, 1) AS share FROM g JOIN b USING (c_custkey, level) WHERE pos < 3
""",
)
def tagged_cards(spark: SparkSession, d: str) -> DataFrame:
    """The first three cards of each page's first list with one of two tags, and the share of decks that play them."""
    found = pagejson.sections(_pages(spark, d), "c_custkey")
    return citing.first_tagged(found, "c_custkey", ["t4", "t2"], 3).select("c_custkey", "pos", "name", "share")


@query(
    "primer_sentences",
    """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'The [[' || p_name || ']] and [' || p_type || ']' || '.' WHEN 1 THEN 'Ends “' || p_name || '”' WHEN 2 THEN '' ELSE 'A [[' || p_name || ']]!' END AS text FROM part
""",
)
def primer_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Primer text with links to known cards only, closed by a mark."""
    n, kind = F.col("p_name"), F.col("p_size") % 4
    text = F.when(kind == 0, F.concat(F.lit("  The [["), n, F.lit("]] and [["), F.col("p_type"), F.lit("]] "))).when(kind == 1, F.concat(F.lit("Ends “"), n, F.lit("”\n"))).when(kind == 2, " ").otherwise(F.concat(F.lit("A [["), n, F.lit("]]!")))
    return table(spark, d, "part").select("p_partkey", citing.sentence(citing.primer(text, F.array(n))).alias("text"))
