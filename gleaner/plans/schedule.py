"""Schedules and local events: tagging cascade, horizon and normalised rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions import dates
from gleaner.operators import tagging
from gleaner.plans.bindings import NOW
from gleaner.plans.registry import query
from gleaner.session import table

CITIES = ["Tokyo", "SEA Championship Manila", "Guatemala City", "london", "Nowhere", "Marly Open", "São Paulo", "F2F Tour", "Champions Cup Lima"]
TITLES = ["Standard", "sealed", "Modernist", "Pauper and Draft", "COMMANDER", "", "Timeless/Vintage", "Historic-Brawl"]
HOSTS = ["events.example.com", "www.events.example.com"]
URLS = ["https://events.example.com/news/a", "http://events.example.com/news/b", "https://events.example.com/schedule/", "https://other.example.org/x", "https://www.events.example.com/c?d=1"]


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


EVENTS = f"""ev AS (
  SELECT p_partkey AS id, p_brand || ' ' || {_list(TITLES)}[p_size % 8 + 1] || ': ' || {_list(CITIES)}[CAST(p_partkey % 9 AS INTEGER) + 1] AS name, CASE WHEN p_size % 10 = 3 THEN 'CommandFest' ELSE p_type END AS type,
    {_list(URLS)}[CAST(p_partkey % 5 AS INTEGER) + 1] || CASE WHEN p_partkey % 5 IN (0, 4) THEN '-' || p_size ELSE '' END AS url FROM part
)"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    at = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    tail = F.when((F.col("p_partkey") % 5).isin(0, 4), F.concat(F.lit("-"), F.col("p_size").cast("string"))).otherwise("")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat("p_brand", F.lit(" "), at(TITLES, F.col("p_size")), F.lit(": "), at(CITIES, F.col("p_partkey"))).alias("name"),
        F.when(F.col("p_size") % 10 == 3, "CommandFest").otherwise(F.col("p_type")).alias("type"),
        F.concat(at(URLS, F.col("p_partkey")), tail).alias("url"),
    )


@query(
    "event_regions",
    f"""
WITH {EVENTS} SELECT id, name, CASE {" ".join(f"WHEN regexp_matches(lower(name), '{'|'.join(k.lower() for k in keywords)}') THEN '{label}'" for label, keywords in tagging.REGIONS.items())} END AS region,
  CASE WHEN contains(name, ': ') THEN trim(substr(name, strpos(name, ': ') + 2)) END AS place FROM ev
""",
)
def event_regions(spark: SparkSession, d: str) -> DataFrame:
    """The first region a name's keyword belongs to, and the place after the colon."""
    place = F.trim(F.element_at(F.split("name", ": ", 2), 2))
    return _events(spark, d).select("id", "name", tagging.region(F.col("name")).alias("region"), F.when(F.contains("name", F.lit(": ")), place).alias("place"))


_RULE = f"""list_filter({_list(tagging.FORMATS)}, lambda f: regexp_matches(name, '(?i)(^|\\W)' || f || '($|\\W)') OR f = 'Limited' AND regexp_matches(name, '(?i)(^|\\W)(draft|sealed)($|\\W)') OR f = 'Commander' AND type = 'CommandFest')"""


@query("event_name_tags", f"""WITH {EVENTS} SELECT id, array_to_string({_RULE}, ',') AS formats FROM ev""")
def event_name_tags(spark: SparkSession, d: str) -> DataFrame:
    """Formats that the name's whole words or the type settle, in the fixed order."""
    return _events(spark, d).select("id", F.array_join(tagging.name_tags(F.col("name"), F.col("type")), ",").alias("formats"))


@query(
    "tagged_events",
    f"""
WITH {EVENTS}, r AS (SELECT *, {_RULE} AS rule, p_size % 4 <> 0 AS readable, p_name AS text, CASE WHEN regexp_matches(url, '^https://(www\\.)?events\\.example\\.com/') AND NOT regexp_matches(url, '/schedule/?$') THEN url END AS article FROM ev JOIN part ON p_partkey = id),
a AS (SELECT article AS url, max(CASE WHEN readable THEN text END) AS text FROM r WHERE article IS NOT NULL GROUP BY 1),
x AS (SELECT r.*, a.text AS read, id % 17 = 0 AS own, id % 3 = 0 AS cached, CASE WHEN id % 2 = 0 THEN sha256(concat_ws(chr(10), name, a.text)) ELSE 'old' END AS hash FROM r LEFT JOIN a ON a.url = r.article),
s AS (SELECT *, CASE WHEN own THEN 'override' WHEN len(rule) > 0 THEN 'rule' WHEN article IS NULL THEN 'none' WHEN cached AND (read IS NULL OR hash = sha256(concat_ws(chr(10), name, read))) THEN 'cache' WHEN read IS NULL THEN 'none' ELSE 'due' END AS source FROM x)
SELECT id, CASE source WHEN 'override' THEN CASE WHEN id % 34 = 0 THEN '' ELSE 'Standard,Modern' END WHEN 'rule' THEN array_to_string(rule, ',') WHEN 'cache' THEN 'Legacy,Brawl' ELSE '' END AS formats, source FROM s
""",
)
def tagged_events(spark: SparkSession, d: str) -> DataFrame:
    """Formats by hand-kept tags, then rules, then the answer cached for this name and article text; others are due."""
    events, part = _events(spark, d), table(spark, d, "part")
    own = part.where("p_partkey % 17 = 0").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 34 == 0, F.array().cast("array<string>")).otherwise(F.array(*map(F.lit, ["Modern", "Nonsense", "Standard"]))).alias("tags"))
    linked = events.withColumn("url", tagging.article(F.col("url"), HOSTS)).where("url is not null").join(part.select(F.col("p_partkey").alias("id"), "p_size", "p_name"), "id")
    pages = linked.groupBy("url").agg(F.max(F.when(F.col("p_size") % 4 != 0, F.col("p_name"))).alias("text"))
    digest = F.sha2(F.concat_ws("\n", "name", "text").cast("binary"), 256)
    with_text = events.withColumn("url", tagging.article(F.col("url"), HOSTS)).join(pages, "url", "left")
    cache = with_text.where("id % 3 = 0").select("id", F.when(F.col("id") % 2 == 0, digest).otherwise("old").alias("hash"), F.array(F.lit("Brawl"), F.lit("Legacy")).alias("tags"))
    return tagging.tagged(events, own, cache, pages, HOSTS).select("id", F.array_join("formats", ",").alias("formats"), "source")


@query(
    "located_events",
    f"""
WITH e AS (SELECT o_orderkey, o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER) AS start, o_totalprice, c_name, n_name, c_acctbal, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey)
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(start, '%Y-%m-%dT%H:%M:%SZ') AS start, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS fee,
  concat_ws(', ', CASE WHEN o_orderkey % 5 <> 0 THEN c_name END, CASE WHEN o_orderkey % 4 <> 0 THEN n_name END, '10-' || (o_orderkey % 7)) AS address, coalesce(c_acctbal > 5000, false) AS premium, array_to_string(list_filter([lower(o_orderpriority), 'all'], lambda t: t <> 'all'), ',') AS tags
FROM e WHERE start >= TIMESTAMP '{NOW}' - INTERVAL 12 HOUR AND start <= TIMESTAMP '{NOW}' + INTERVAL 30 DAY
""",
)
def located_events(spark: SparkSession, d: str) -> DataFrame:
    """Events from twelve hours ago to the horizon, in the published shape; missing parts of an address are left out."""
    people = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    k, now = F.col("o_orderkey"), F.lit(NOW).cast("timestamp")
    e = table(spark, d, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
    e = e.withColumn("start", F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=(k % 24).cast("int")))
    e = e.where((F.col("start") >= now - F.expr("interval 12 hours")) & (F.col("start") <= now + F.expr("interval 30 days")))
    place = tagging.address(F.when(k % 5 != 0, F.col("c_name")).otherwise(""), F.when(k % 4 != 0, F.col("n_name")), F.concat(F.lit("10-"), (k % 7).cast("string")))
    tags = F.filter(F.array(F.lower("o_orderpriority"), F.lit("all")), lambda t: t != "all")
    return e.select(k.cast("string").alias("id"), dates.stamp(F.col("start")).alias("start"), F.when(k % 3 != 0, F.col("o_totalprice")).alias("fee"), place.alias("address"), F.coalesce(F.col("c_acctbal") > 5000, F.lit(False)).alias("premium"), F.array_join(tags, ",").alias("tags"))
