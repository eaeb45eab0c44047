"""The merge plan applied: nations of a format whose numbers lie in one ten are a group under the first.

Decks with an order status F have an archetype; of the others those in first place joined the group of their nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.operators import merged
from gleaner.plans.bindings import CATALOG, DECKS, LINES, NOW, catalog, decks, lines
from gleaner.plans.registry import query

#: Days of the windows.
WINDOWS = (400, 800, 1600)


def _rows(spark: SparkSession, d: str) -> DataFrame:
    leader = F.concat(F.lit("NATION_"), F.expr("cast(substr(archetype, 8) as int) div 10 * 10 + cast(substr(archetype, 8) as int) % 5").cast("string"))
    return decks(spark, d).withColumnRenamed("format", "group").withColumn("_leader", leader)


def _plan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """plan, joined (with the columns of results) and names."""
    rows = _rows(spark, d)
    plan = rows.select("group", F.col("archetype").alias("id"), F.col("_leader").alias("leader")).distinct()
    joined = rows.where("not published and place = 1").select("group", F.col("_leader").alias("leader"), "deck_id", "ts", "player")
    names = rows.select("group", F.col("archetype").alias("id"), F.concat_ws(" of ", F.lower("archetype"), "group").alias("name")).distinct()
    return plan, joined, names


_BASE = f"""
{DECKS}, rows AS (SELECT *, 'NATION_' || CAST(CAST(substr(archetype, 8) AS INTEGER) // 10 * 10 + CAST(substr(archetype, 8) AS INTEGER) % 5 AS VARCHAR) AS leader FROM decks),
joined AS (SELECT format, leader, deck_id, ts, player FROM rows WHERE NOT published AND place = 1),
names AS (SELECT DISTINCT format, archetype AS id, lower(archetype) || ' of ' || format AS name FROM rows)
"""


@query("merged_list", f"""WITH {_BASE} SELECT DISTINCT format, archetype AS id, leader FROM rows WHERE archetype <> leader""")
def merged_list(spark: SparkSession, d: str) -> DataFrame:
    """What was merged into what."""
    return merged.merges(_plan(spark, d)[0]).withColumnRenamed("group", "format")


@query(
    "merged_events",
    f"""
WITH {_BASE}
SELECT r.format, deck_id, CASE WHEN published THEN leader WHEN place = 1 THEN leader END AS archetype_id,
  CASE WHEN published AND archetype = leader THEN lower(archetype) WHEN published OR place = 1 THEN coalesce(n.name, CASE WHEN published THEN lower(archetype) ELSE 'other' END) ELSE 'other' END AS archetype
FROM rows r LEFT JOIN names n ON n.format = r.format AND n.id = r.leader
""",
)
def merged_events(spark: SparkSession, d: str) -> DataFrame:
    """Event results under their leaders, and those without an archetype under the leader they joined."""
    plan, joined, names = _plan(spark, d)
    results = _rows(spark, d).select("group", "deck_id", F.when(F.col("published"), F.col("archetype")).alias("archetype_id"), F.when(F.col("published"), F.lower("archetype")).otherwise("other").alias("archetype"))
    return merged.events(results, plan, joined, names).withColumnRenamed("group", "format")


@query(
    "merged_histories",
    f"""
WITH {_BASE}, x AS (
  SELECT format, leader, deck_id, CASE WHEN archetype = leader THEN 0 ELSE 1 END AS source, ts, player FROM rows WHERE published
  UNION ALL SELECT format, 'NATION_0', deck_id, CASE WHEN archetype = 'NATION_0' THEN 1 ELSE 0 END, ts, player FROM rows WHERE published AND leader = 'NATION_0' AND place <= 2
  UNION ALL SELECT format, leader, deck_id, 2, ts, player FROM joined)
SELECT format, leader, deck_id, CAST(min(source) AS INTEGER) AS source, min(ts) AS ts, min(player) AS player FROM x GROUP BY 1, 2, 3
""",
)
def merged_histories(spark: SparkSession, d: str) -> DataFrame:
    """Results of a group, the leader's own first, then its members', then those that joined, each deck once. The first pair's results of the first places are listed under both."""
    plan, joined, _ = _plan(spark, d)
    rows = _rows(spark, d).where("published")
    results = rows.select("group", F.col("archetype").alias("id"), "deck_id", "ts", "player")
    other = rows.where("_leader = 'NATION_0' and place <= 2").select("group", F.when(F.col("archetype") == "NATION_0", "NATION_5").otherwise("NATION_0").alias("id"), "deck_id", "ts", "player")
    return merged.histories(results.unionByName(other), plan, joined).withColumnRenamed("group", "format").select("format", "leader", "deck_id", "source", "ts", "player")


def _known(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).join(catalog(spark, d).select("slug", "color"), "slug").groupBy("deck_id").agg(F.array_sort(F.collect_set("color")).alias("colors"))


def _tiles(spark: SparkSession, d: str) -> DataFrame:
    """A format's archetypes in each window that they have decks in, by share; the count is unknown where no deck came first."""
    rows = _rows(spark, d).where("published")
    age = F.datediff(F.lit(NOW).cast("timestamp"), F.col("ts"))
    windows = F.explode(F.filter(F.array(*(F.when(age.between(0, n), n) for n in WINDOWS)), lambda n: n.isNotNull())).alias("days")
    x = rows.select("group", "archetype", "deck_id", "place", windows)
    n = x.groupBy("group", "days", F.col("archetype").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("p"), F.min_by("deck_id", F.struct("place", "deck_id")).alias("featured"))
    total = x.groupBy("group", "days").agg(F.count(F.lit(1)).alias("t"))
    share = F.round(100 * F.col("n") / F.col("t"), 1)
    y = n.join(total, ["group", "days"])
    return y.select("group", "days", F.struct(-share, "id").alias("pos"), "id", F.lower("id").alias("name"), share.alias("percentage"), F.when(F.col("p") == 1, F.col("n")).alias("deck_count"), "featured", F.array(F.lit(9)).alias("colors"))


@query(
    "merged_metagame",
    f"""
WITH {_BASE}, {LINES}, {CATALOG},
known AS (SELECT DISTINCT deck_id, color FROM lines JOIN catalog USING (slug)), has AS (SELECT DISTINCT deck_id FROM known),
of AS (SELECT DISTINCT format, leader, deck_id FROM rows WHERE published UNION SELECT format, leader, deck_id FROM joined),
cn AS (SELECT format, leader, count(*) AS n FROM of JOIN has USING (deck_id) GROUP BY 1, 2),
cc AS (SELECT format, leader, color, count(*) AS k FROM of JOIN known USING (deck_id) GROUP BY 1, 2, 3),
colors AS (SELECT format, leader, coalesce(string_agg(CASE WHEN 2 * k >= n THEN CAST(color AS VARCHAR) END, '' ORDER BY color), '') AS colors FROM cn JOIN cc USING (format, leader) GROUP BY 1, 2),
w AS (SELECT r.*, days FROM rows r, (VALUES {", ".join(f"({n})" for n in WINDOWS)}) v(days) WHERE published AND date_diff('day', CAST(ts AS DATE), DATE '{NOW[:10]}') BETWEEN 0 AND days),
t AS (SELECT format, days, archetype AS id, leader, count(*) AS n, CASE WHEN min(place) = 1 THEN count(*) END AS deck_count, arg_min(deck_id, (place, deck_id)) AS featured FROM w GROUP BY 1, 2, 3, 4),
s AS (SELECT *, round(100 * n / sum(n) OVER (PARTITION BY format, days), 1) AS percentage FROM t),
g AS (SELECT format, days, leader, round(sum(percentage), 1) AS percentage, CASE WHEN count(deck_count) = count(*) THEN sum(deck_count) END AS deck_count, max(CASE WHEN id = leader THEN featured END) AS own, arg_min(featured, (-percentage, id)) AS first_, arg_min(id, (-percentage, id)) AS first_id FROM s GROUP BY 1, 2, 3),
l AS (SELECT format, id AS leader, arg_max(featured, days) AS long_ FROM s GROUP BY 1, 2)
SELECT g.format, CAST(g.days AS INTEGER) AS days, g.leader AS id, percentage, CAST(deck_count AS BIGINT) AS deck_count, coalesce(n.name, lower(g.first_id)) AS name, coalesce(own, long_, first_) AS featured, coalesce(colors, '9') AS colors
FROM g LEFT JOIN l ON l.format = g.format AND l.leader = g.leader LEFT JOIN names n ON n.format = g.format AND n.id = g.leader LEFT JOIN colors c ON c.format = g.format AND c.leader = g.leader
""",
)
def merged_metagame(spark: SparkSession, d: str) -> DataFrame:
    """One tile per group and window: shares and counts added up, the rest from the leader's tile, colours by majority."""
    plan, joined, names = _plan(spark, d)
    rows = _rows(spark, d).where("published").select("group", F.col("archetype").alias("id"), "deck_id")
    out = merged.metagame(_tiles(spark, d), plan, names, merged.colors_of_groups(rows, plan, joined, _known(spark, d)))
    return out.select(F.col("group").alias("format"), "days", "id", "percentage", "deck_count", "name", "featured", F.array_join(F.transform("colors", lambda c: c.cast("string")), "").alias("colors"))
