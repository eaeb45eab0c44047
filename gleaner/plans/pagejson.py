"""JSON pages of customers and nations whose fields drift by market segment, caches with an age, published versions, articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.operators import state, versions
from gleaner.plans.bindings import DECKS, NOW, decks
from gleaner.plans.registry import query
from gleaner.session import table
from gleaner.sources import html, pagejson


def _quoted(number: Column, quoted: Column) -> Column:
    """A number of JSON, as a string where quoted."""
    return F.when(quoted, F.concat(F.lit('"'), number.cast("string"), F.lit('"'))).otherwise(number.cast("string"))


def _listed(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def customer_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page per customer with orders. Segments drift: AUTOMOBILE has its count as a string, BUILDING its salt, MACHINERY has an object
    in place of the lists, FURNITURE a word among the bracket counts; orders with status P count in fractions, those with O have no name."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("level"), F.month("o_orderdate").alias("month"))
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    decks_ = F.when(status == "P", F.lit("2.5")).otherwise((k % 50).cast("string"))
    name = F.when(status == "O", F.lit("")).otherwise(F.concat(F.lit('"name":"card '), k.cast("string"), F.lit('",')))
    of = F.when(k % 2 == 0, F.concat(F.lit(',"potential_decks":'), (k % 100 + 1).cast("string"))).otherwise("")
    view = F.concat(F.lit("{"), name, F.lit('"num_decks":'), decks_, of, F.lit(',"synergy":'), ((k % 200 - 100) / 150.0).cast("string"), F.lit("}"))
    by = orders.withColumn("view", view).groupBy("o_custkey", "level").agg(F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "view"))), lambda x: x["view"]).alias("views"))
    one = F.concat(F.lit('{"tag":"t'), F.col("level"), F.lit('","header":"Level '), F.col("level"), F.lit('","cardviews":'), _listed(F.col("views")), F.lit("}"))
    lists = by.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", one.alias("l")))), lambda x: x["l"]).alias("lists"), F.transform(F.array_sort(F.collect_list(F.struct("level", "n"))), lambda x: F.concat(F.lit('"'), x["level"], F.lit('":'), x["n"].cast("string"))).alias("brackets"))
    tags = orders.groupBy("o_custkey", "month").agg(F.count(F.lit(1)).alias("n"))
    tag = F.concat(F.lit('{"slug":"m'), F.col("month").cast("string"), F.lit('","value":"Month '), F.col("month").cast("string"), F.lit('","count":'), F.col("n").cast("string"), F.lit("}"))
    themes = tags.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("month", tag.alias("t")))), lambda x: x["t"]).alias("tags"))
    n = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("decks"))
    x = table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey")).join(lists, "o_custkey").join(themes, "o_custkey")
    is_ = lambda s: F.col("c_mktsegment") == s
    card = F.concat(F.lit('{"name":"'), F.col("c_name"), F.lit('","num_decks":'), _quoted(F.col("decks"), is_("AUTOMOBILE")), F.lit(',"potential_decks":'), F.col("decks") * 10, F.lit(',"salt":'), _quoted(F.floor("c_acctbal") / 128, is_("BUILDING")), F.lit("}"))
    odd = lambda *items: F.array(*map(F.lit, items))
    counts = F.when(is_("FURNITURE"), F.concat(F.filter("brackets", lambda b: ~F.startswith(b, F.lit('"3"'))), odd('"3":"many"', '"6":1', '"x":2'))).otherwise(F.concat("brackets", odd('"7":1')))
    brackets = F.concat(F.lit("{"), F.array_join(counts, ","), F.lit("}"))
    body = F.concat(
        F.lit('{"container":{"json_dict":{"card":'), card, F.lit(',"cardlists":'), F.when(is_("MACHINERY"), F.lit('{"none":1}')).otherwise(_listed(F.col("lists"))), F.lit('}},"tag_counts":'), _listed(F.concat("tags", F.array(F.lit('{"slug":"bad","value":"Bad","count":"3"}'), F.lit("7")))),
        F.lit(',"bracket_counts":'), brackets, F.lit(',"land":'), _quoted(F.col("decks") + 30, is_("AUTOMOBILE")), F.lit("}"),
    )
    return x.select("c_custkey", body.alias("body"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return pagejson.parsed(customer_pages(spark, d), "c_custkey", "body")


_N = "n AS (SELECT c_custkey, c_name, c_mktsegment AS seg, c_acctbal, count(*) AS decks FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"
_ENTRY = f"""{_N}, l AS (SELECT o_custkey, left(o_orderpriority, 1) AS level, count(*) AS n FROM orders GROUP BY 1, 2),
b AS (SELECT c_custkey, string_agg(level || '=' || n, ';' ORDER BY level) AS bracket_decks FROM n JOIN l ON o_custkey = c_custkey WHERE NOT (seg = 'FURNITURE' AND level = '3') GROUP BY 1),
e AS (SELECT n.c_custkey, c_name AS name, decks, decks * 10 AS of_decks, CASE WHEN seg <> 'BUILDING' THEN round(floor(c_acctbal) / 128, 2) + 0.0 END AS salt, decks + 30 AS lands, coalesce(bracket_decks, '') AS bracket_decks FROM n LEFT JOIN b ON b.c_custkey = n.c_custkey WHERE seg <> 'AUTOMOBILE')"""


def _told(df: DataFrame) -> DataFrame:
    told = F.array_join(F.transform(F.array_sort(F.map_entries("bracket_decks")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    return df.select("c_custkey", "name", "decks", "of_decks", "salt", "lands", told.alias("bracket_decks"))


@query("page_entry", f"WITH {_ENTRY} SELECT * FROM e")
def page_entry(spark: SparkSession, d: str) -> DataFrame:
    """The entry of each page, with types checked field by field."""
    return _told(pagejson.entries(_pages(spark, d), "c_custkey"))


@query("usable_entries", f"WITH {_ENTRY} SELECT * FROM e WHERE decks >= 10")
def usable_entries(spark: SparkSession, d: str) -> DataFrame:
    """entries of pages with enough decks."""
    return _told(pagejson.usable(pagejson.entries(_pages(spark, d), "c_custkey"), 10))


@query(
    "page_sections",
    f"""
WITH {_N}, o AS (SELECT o_custkey, o_orderkey AS k, left(o_orderpriority, 1) AS level, o_orderstatus AS s, dense_rank() OVER (PARTITION BY o_custkey ORDER BY left(o_orderpriority, 1)) - 1 AS list FROM orders)
SELECT c_custkey, CAST(list AS INTEGER) AS list, 't' || level AS tag, CAST(row_number() OVER (PARTITION BY c_custkey, level ORDER BY k) - 1 AS INTEGER) AS pos, 'card ' || k AS name, k % 50 AS decks,
  CASE WHEN k % 2 = 0 THEN k % 100 + 1 WHEN seg <> 'AUTOMOBILE' THEN decks END AS of_decks, round((k % 200 - 100) / 150.0, 2) + 0.0 AS synergy
FROM o JOIN n ON o_custkey = c_custkey WHERE seg <> 'MACHINERY' AND s NOT IN ('P', 'O')
""",
)
def page_sections(spark: SparkSession, d: str) -> DataFrame:
    """The cards of each page's lists."""
    return pagejson.sections(_pages(spark, d), "c_custkey").select("c_custkey", "list", "tag", "pos", "name", "decks", "of_decks", "synergy")


_THEMES = "t AS (SELECT o_custkey AS c_custkey, month(o_orderdate) AS m, count(*) AS decks FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2), r AS (SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY decks DESC, m) AS INTEGER) AS pos, 'm' || m AS slug, 'Month ' || m AS name, decks FROM t)"


@query("page_themes", f"WITH {_THEMES} SELECT * FROM r")
def page_themes(spark: SparkSession, d: str) -> DataFrame:
    """The themes of each page, those with most decks first."""
    return pagejson.themes(_pages(spark, d), "c_custkey")


@query("shown_themes", f"WITH {_THEMES} SELECT * FROM r WHERE decks >= 2 AND pos <= 5")
def shown_themes(spark: SparkSession, d: str) -> DataFrame:
    """The first five themes of enough decks."""
    return pagejson.shown_themes(pagejson.themes(_pages(spark, d), "c_custkey"), 2)


@query(
    "page_ranks",
    """
WITH c AS (SELECT c_nationkey, c_custkey AS k, c_name, c_acctbal, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS decks, c_mktsegment AS seg FROM customer)
SELECT c_nationkey, CAST(CASE WHEN k % 3 = 0 THEN k ELSE row_number() OVER (PARTITION BY c_nationkey ORDER BY k) END AS BIGINT) AS rank, 'c' || k AS slug, c_name AS name, decks, CASE WHEN seg <> 'BUILDING' THEN round(floor(c_acctbal) / 128, 1) + 0.0 END AS trend
FROM c WHERE seg <> 'MACHINERY'
""",
)
def page_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The ranked rows of a nation's page; even nations have them at the top of the page, odd ones in its first list."""
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer").join(n, F.col("o_custkey") == F.col("c_custkey"), "left")
    k, is_ = F.col("c_custkey"), lambda s: F.col("c_mktsegment") == s
    rank = F.when(k % 3 == 0, F.concat(F.lit(',"rank":'), k.cast("string"))).otherwise("")
    view = F.concat(F.lit('{"sanitized":"c'), k.cast("string"), F.lit('","name":"'), F.col("c_name"), F.lit('","num_decks":'), _quoted(F.coalesce("n", F.lit(0)), is_("MACHINERY")), F.lit(',"trend_zscore":'), _quoted(F.floor("c_acctbal") / 128, is_("BUILDING")), rank, F.lit("}"))
    views = c.select("c_nationkey", F.struct(k.alias("k"), view.alias("v")).alias("v")).groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list("v")), lambda x: x["v"]).alias("views"))
    even = F.col("c_nationkey") % 2 == 0
    body = F.when(even, F.concat(F.lit('{"cardviews":'), _listed(F.col("views")), F.lit(',"container":{"json_dict":{"cardlists":[]}}}'))).otherwise(F.concat(F.lit('{"cardviews":"none","container":{"json_dict":{"cardlists":[{"cardviews":'), _listed(F.col("views")), F.lit("}]}}}")))
    return pagejson.ranked(pagejson.parsed(views.select("c_nationkey", body.alias("body")), "c_nationkey", "body"), "c_nationkey")


#: Pages that may be fetched in a run.
BUDGET = 150


@query(
    "cached_counts",
    f"""
WITH o AS (SELECT o_custkey AS k, count(*) AS n, CAST(max(o_orderdate) FILTER (o_orderdate < TIMESTAMP '{NOW}') AS TIMESTAMP) AS seen, count(*) FILTER (o_orderdate < TIMESTAMP '{NOW}') AS before, count(*) FILTER (CAST(o_orderdate AS DATE) = DATE '{NOW[:10]}') AS today FROM orders GROUP BY 1),
x AS (SELECT c_custkey, c_acctbal, c_mktsegment AS seg, n, seen, today, CASE WHEN c_mktsegment <> 'FURNITURE' AND before > 0 THEN before END AS old, date_diff('day', CAST(seen AS DATE), DATE '{NOW[:10]}') <= 7 AS fresh FROM customer LEFT JOIN o ON k = c_custkey),
y AS (SELECT *, CASE WHEN today > 0 THEN 'page' WHEN fresh THEN 'cache' END AS t FROM x), w AS (SELECT c_custkey, true AS may FROM y WHERE t IS NULL ORDER BY -c_acctbal, c_custkey LIMIT {BUDGET}),
z AS (SELECT y.*, CASE WHEN t IS NOT NULL THEN t WHEN may AND seg <> 'MACHINERY' THEN 'fetched' WHEN old IS NOT NULL THEN 'stale' ELSE 'none' END AS tier FROM y LEFT JOIN w USING (c_custkey))
SELECT c_custkey, tier, CASE tier WHEN 'page' THEN today WHEN 'fetched' THEN CASE WHEN seg <> 'HOUSEHOLD' THEN n END WHEN 'none' THEN NULL ELSE old END AS value,
  CASE tier WHEN 'page' THEN today WHEN 'fetched' THEN CASE WHEN seg <> 'HOUSEHOLD' THEN n END ELSE old END AS kept, CASE WHEN tier IN ('page', 'fetched') THEN TIMESTAMP '{NOW}' ELSE seen END AS checked_at
FROM z
""",
)
def cached_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of customers from this run's page, a cache of a week, a budget of fetches, or the cache however old; what isn't there is remembered too."""
    now, orders, c = F.lit(NOW).cast("timestamp"), table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("ts")), table(spark, d, "customer")
    key = F.col("o_custkey").alias("c_custkey")
    segment = c.select("c_custkey", "c_mktsegment")
    pages = orders.where(F.to_date("ts") == F.to_date(now)).groupBy(key).agg(F.count(F.lit(1)).alias("value"))
    cache = orders.where(F.col("ts") < now).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("checked_at")).join(segment, "c_custkey")
    cache = cache.select("c_custkey", F.when(F.col("c_mktsegment") != "FURNITURE", F.col("n")).alias("value"), "checked_at")
    counts = segment.join(orders.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "c_custkey", "left")
    fetched = counts.select("c_custkey", F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("n")).alias("value"), (F.col("c_mktsegment") != "MACHINERY").alias("ok"))
    return state.answered(c.select("c_custkey", (-F.col("c_acctbal")).alias("pos")), pages, cache, fetched, "c_custkey", now, 7, BUDGET).drop("pos")


#: Patches of the bound versions before a rebase.
PATCHES = 3


@query(
    "patched_versions",
    f"""
WITH y AS (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem), v AS (SELECT y, (row_number() OVER (ORDER BY y) - 1) AS run FROM y),
l AS (SELECT l_partkey AS id, run, max(l_shipdate) AS uri, CAST(sum(l_quantity) AS BIGINT) AS value FROM lineitem JOIN v ON y = year(l_shipdate) GROUP BY 1, 2)
SELECT id, CAST(uri AS TIMESTAMP) AS uri, value, CASE WHEN run >= m THEN CAST((run - m) AS INTEGER) ELSE 0 END AS patch, CAST((SELECT max(run) FROM v) // {PATCHES + 1} + 1 AS INTEGER) AS master
FROM l, (SELECT max(run) // {PATCHES + 1} * {PATCHES + 1} AS m FROM v) QUALIFY row_number() OVER (PARTITION BY id ORDER BY run DESC) = 1
""",
)
def patched_versions(spark: SparkSession, d: str) -> DataFrame:
    """Results of a run a year, published as a base and patches that a rebase folds in; read as last writer wins."""
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_shipdate").cast("timestamp").alias("ts"), "l_quantity")
    span = lines.agg(F.year(F.min("ts")), F.year(F.max("ts"))).first()
    version, current = None, None
    for year in range(span[0], span[1] + 1):
        new = lines.where(F.year("ts") == year).groupBy("id").agg(F.max("ts").alias("uri"), F.sum("l_quantity").cast("long").alias("value"))
        old = versions.reading(version).select("id", "uri") if version else None
        current = new.select("id", "uri") if old is None else old.join(new.select("id"), "id", "left_anti").unionByName(new.select("id", "uri"))
        version = versions.advanced(version, current, new.select("id", "value"), PATCHES)
    return versions.reading(version).withColumn("master", F.lit(version.master))


@query("article_texts")
def article_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of each page's main article, line by line, 20,000 characters at most."""
    return html.articles(table(spark, d, "pages"), "page_id", "html")


@query("open_window_shares", f"WITH {DECKS}, x AS (SELECT * FROM decks WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 400 DAY) SELECT format, archetype, count(*) AS decks, count(*) / sum(count(*)) OVER (PARTITION BY format) AS share FROM x GROUP BY 1, 2")
def open_window_shares(spark: SparkSession, d: str) -> DataFrame:
    """shares of a window that has a first day and no last one."""
    x = decks(spark, d).where(F.col("ts") >= F.lit(NOW).cast("timestamp") - F.expr("interval 400 days")).groupBy("format", "archetype").agg(F.count(F.lit(1)).alias("decks"))
    total = x.groupBy("format").agg(F.sum("decks").alias("_t"))
    return x.join(total, "format").select("format", "archetype", "decks", (F.col("decks") / F.col("_t")).alias("share"))
