"""Deck, combination and set queries: every deck, part and line counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.functions import text
from gleaner.operators import containment, diff, guides, priority, similarity, tallies
from gleaner.plans.bindings import CATALOG, DECKS, LINES, catalog, decks, lines
from gleaner.plans.registry import query
from gleaner.plans.relations import clusters
from gleaner.session import table

_VEC = f"""{DECKS}, {LINES}, v AS (SELECT archetype, slug, sum(least(qty, 4)) AS w FROM decks JOIN lines USING (deck_id) GROUP BY 1, 2), nrm AS (SELECT archetype, sqrt(sum(w * w)) AS n FROM v GROUP BY 1)"""
_COMBOS = """SELECT DISTINCT p_brand || '/' || p_size AS combo, p_brand, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part"""


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = decks(spark, d).select("deck_id", "archetype", "format")
    return lines(spark, d).join(rows, "deck_id").groupBy("format", "archetype", "slug").agg(F.sum(F.least("qty", F.lit(4))).alias("w"))


def _combos(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.concat_ws("/", "p_brand", "p_size").alias("combo"), "p_brand", text.ascii_slug(F.col("p_name")).alias("slug"))


def _week() -> Column:
    return F.to_date(F.date_trunc("week", "ts")).alias("week")


def _lists(spark: SparkSession, d: str, *columns: str | Column) -> DataFrame:
    return lines(spark, d).join(decks(spark, d).select("deck_id", *columns), "deck_id")


@query(
    "archetype_cosines",
    f"""WITH {_VEC} SELECT a.archetype AS a, b.archetype AS b, round(sum(a.w * b.w) / (x.n * y.n), 9) AS cosine FROM v a JOIN v b USING (slug) JOIN nrm x ON x.archetype = a.archetype JOIN nrm y ON y.archetype = b.archetype WHERE a.archetype < b.archetype GROUP BY a.archetype, b.archetype, x.n, y.n""",
)
def archetype_cosines(spark: SparkSession, d: str) -> DataFrame:
    """Cosines of archetype pairs over the cards of all decks."""
    return similarity.self_cosine(_vectors(spark, d).drop("format"), "archetype", ["slug"]).withColumn("cosine", F.round("cosine", 9))


@query("leader_clusters")
def leader_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Leader clustering of each format's archetypes by all of their decks."""
    return clusters(spark, d, _vectors(spark, d))


@query(
    "nearest_profile",
    f"""
WITH {_VEC}, x AS (SELECT deck_id, slug, sum(least(qty, 4)) AS w FROM lines JOIN decks USING (deck_id) GROUP BY 1, 2), xn AS (SELECT deck_id, sqrt(sum(w * w)) AS n FROM x GROUP BY 1), sz AS (SELECT archetype, count(*) AS decks FROM decks GROUP BY 1),
c AS (SELECT x.deck_id, v.archetype, sum(x.w * v.w) / (xn.n * nrm.n) AS cosine, decks FROM x JOIN v USING (slug) JOIN xn ON xn.deck_id = x.deck_id JOIN nrm ON nrm.archetype = v.archetype JOIN sz ON sz.archetype = v.archetype GROUP BY x.deck_id, v.archetype, xn.n, nrm.n, decks)
SELECT deck_id, archetype, round(cosine, 9) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY deck_id ORDER BY round(cosine, 12) DESC, decks DESC, archetype) AS k FROM c WHERE cosine >= 0.25) WHERE k = 1
""",
)
def nearest_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every deck's nearest profile at a threshold, ties to the bigger."""
    rows = decks(spark, d)
    lists = lines(spark, d, each=100_000).join(rows.select("deck_id"), "deck_id").groupBy("deck_id", "slug").agg(F.sum(F.least("qty", F.lit(4))).alias("w"))
    scores = similarity.profile_cosine(lists, _vectors(spark, d).drop("format"), "deck_id", "archetype", ["slug"])
    sizes = rows.groupBy("archetype").agg(F.count(F.lit(1)).alias("decks"))
    return similarity.assigned(scores.join(F.broadcast(sizes), "archetype"), "deck_id", "archetype", "decks", 0.25).select("deck_id", "archetype", F.round("cosine", 9).alias("cosine"))


@query(
    "consensus_lists",
    f"""
WITH {DECKS}, {LINES}, s AS (SELECT archetype, CAST(date_trunc('week', ts) AS DATE) AS week, deck_id, board, slug, qty FROM decks JOIN lines USING (deck_id)),
n AS (SELECT archetype, week, count(DISTINCT deck_id) AS n FROM s GROUP BY 1, 2), p AS (SELECT archetype, week, board, slug, count(*) AS decks, sum(qty) AS copies FROM s GROUP BY ALL)
SELECT archetype, week, board, slug, decks, CAST(greatest(1, floor(copies / decks + 0.5)) AS BIGINT) AS quantity FROM p JOIN n USING (archetype, week) WHERE 2 * decks >= n
""",
)
def consensus_lists(spark: SparkSession, d: str) -> DataFrame:
    """Cards in at least half of an archetype's lists of a week, copies rounded half up."""
    return tallies.consensus(_lists(spark, d, "archetype", _week()), ["archetype", "week"])


@query(
    "flex_cards",
    f"""
WITH {DECKS}, {LINES}, s AS (SELECT archetype, CAST(date_trunc('week', ts) AS DATE) AS week, deck_id, slug FROM decks JOIN lines USING (deck_id) WHERE board = 'main'), n AS (SELECT archetype, week, count(DISTINCT deck_id) AS n FROM s GROUP BY 1, 2), p AS (SELECT archetype, week, slug, count(DISTINCT deck_id) AS k FROM s GROUP BY 1, 2, 3)
SELECT archetype, week, slug, k AS decks FROM p JOIN n USING (archetype, week) WHERE 4 * k >= n AND 2 * k < n QUALIFY row_number() OVER (PARTITION BY archetype, week ORDER BY k DESC, slug) <= 15
""",
)
def flex_cards(spark: SparkSession, d: str) -> DataFrame:
    """Cards of a quarter of an archetype's lists of a week that are not in the consensus, fifteen at most."""
    s, by = _lists(spark, d, "archetype", _week()).where("board = 'main'"), ["archetype", "week"]
    n = s.groupBy(*by).agg(F.count_distinct("deck_id").alias("n"))
    p = s.groupBy(*by, "slug").agg(F.count_distinct("deck_id").alias("decks")).join(n, by).where("4 * decks >= n and 2 * decks < n")
    return priority.top_per_group(p, by, [F.desc("decks"), F.col("slug")], 15).select(*by, "slug", "decks")


@query(
    "majority_colors",
    f"""
WITH {DECKS}, {LINES}, {CATALOG}, s AS (SELECT DISTINCT archetype, deck_id, color FROM decks JOIN lines USING (deck_id) JOIN catalog USING (slug)),
k AS (SELECT archetype, count(DISTINCT deck_id) AS known FROM s GROUP BY 1) SELECT archetype, color, count(*) AS n, known FROM s JOIN k USING (archetype) GROUP BY archetype, color, known HAVING 2 * count(*) >= known
""",
)
def majority_colors(spark: SparkSession, d: str) -> DataFrame:
    """Colours in at least half of all known decks of an archetype."""
    return tallies.majority(_lists(spark, d, "archetype").join(catalog(spark, d).select("slug", "color"), "slug"), ["archetype"], "deck_id", "color")


@query(
    "cards_everywhere",
    f"""
WITH {DECKS}, {LINES}, s AS (SELECT CAST(ts AS DATE) AS day, format, deck_id, slug FROM decks JOIN lines USING (deck_id)), n AS (SELECT day, format, count(DISTINCT deck_id) AS n FROM s GROUP BY 1, 2)
SELECT day, format, slug, count(DISTINCT deck_id) AS decks FROM s JOIN n USING (day, format) GROUP BY day, format, slug, n HAVING count(DISTINCT deck_id) = n
""",
)
def cards_everywhere(spark: SparkSession, d: str) -> DataFrame:
    """Cards in all decks of a day and format."""
    return tallies.everywhere(_lists(spark, d, "format", "ts").withColumn("day", F.to_date("ts")), ["day", "format"])


@query(
    "style_levels",
    f"""
WITH {DECKS}, s AS (SELECT archetype, place AS level, count(*) AS n FROM decks GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY archetype) AS t FROM s),
r AS (SELECT archetype, min(level) FILTER (100 * n >= 10 * t) AS lo, max(level) FILTER (100 * n >= 10 * t) AS hi, arg_max(level, n * 100 - level) AS most_played FROM t GROUP BY 1) SELECT archetype, CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS level, most_played FROM r WHERE lo IS NOT NULL
""",
)
def style_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels with a tenth of all decks, filled to a range, and the most played one."""
    return guides.levels(decks(spark, d).groupBy("archetype", F.col("place").alias("level")).agg(F.count(F.lit(1)).alias("n")), "archetype", "level", "n", 10)


@query(
    "contained_combos",
    f"""
WITH {LINES}, c AS (SELECT combo, slug FROM ({_COMBOS})), n AS (SELECT combo, count(*) AS n FROM c GROUP BY 1), l AS (SELECT DISTINCT deck_id, slug FROM lines)
SELECT combo, deck_id, n - count(*) AS lacking FROM c JOIN n USING (combo) JOIN l USING (slug) GROUP BY combo, deck_id, n HAVING n - count(*) <= 1 AND n > 1
""",
)
def contained_combos(spark: SparkSession, d: str) -> DataFrame:
    """Combinations of all parts (brand and size) that a deck holds or lacks one card of."""
    return containment.contained(_combos(spark, d), lines(spark, d), "combo", "deck_id", "slug", missing=1)


@query(
    "set_signatures",
    """
WITH c AS (SELECT l_orderkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), '|' ORDER BY CAST(l_suppkey AS VARCHAR)) AS signature FROM lineitem GROUP BY 1)
SELECT signature, min(l_orderkey) AS kept, count(*) - 1 AS dropped FROM c GROUP BY 1 HAVING count(*) > 1
""",
)
def set_signatures(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose lines have the same set of suppliers, the first kept."""
    rows = containment.signature(table(spark, d, "lineitem"), ["l_orderkey"], "l_suppkey")
    return rows.groupBy("signature").agg(F.min("l_orderkey").alias("kept"), (F.count(F.lit(1)) - 1).alias("dropped")).where("dropped > 0")


@query(
    "list_differences",
    f"""
WITH {DECKS}, {LINES}, x AS (SELECT archetype, board, slug, coalesce(sum(qty) FILTER (year(ts) = 1998), 0) - coalesce(sum(qty) FILTER (year(ts) = 1997), 0) AS q FROM lines JOIN decks USING (deck_id) GROUP BY 1, 2, 3)
SELECT archetype, board, slug, CAST(greatest(q, 0) AS BIGINT) AS added, CAST(greatest(-q, 0) AS BIGINT) AS removed FROM x WHERE q <> 0
""",
)
def list_differences(spark: SparkSession, d: str) -> DataFrame:
    """Copies added to and removed from every archetype's list from one year to the next."""
    rows = _lists(spark, d, "archetype", "ts")
    total = lambda y: rows.where(F.year("ts") == y).groupBy("archetype", "board", "slug").agg(F.sum("qty").alias("qty"))
    return diff.list_diff(total(1998), total(1997), ["archetype", "board", "slug"], "qty")
