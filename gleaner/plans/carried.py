"""State carried between runs, standings and pages, over the bound tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.operators import guides, priority, standings, state
from gleaner.plans.bindings import CATALOG, DECKS, LINES, NOW, catalog, decks
from gleaner.plans.guides import _PAGES, _page_cards
from gleaner.plans.registry import query
from gleaner.session import shared_folder, table

TODAY = "2024-01-30"


@query("saved_stand_in", """SELECT p_partkey, p_name FROM part WHERE p_size % 2 = 0""")
def saved_stand_in(spark: SparkSession, d: str) -> DataFrame:
    """The last good run's rows stand in for a source that cannot be read, and for one without rows."""
    at = f"{shared_folder(spark)}/missing/{uuid.uuid4().hex}"
    saved = lambda: table(spark, d, "part").where("p_size % 2 = 0").select("p_partkey", "p_name")
    unread, why = state.fresh_or_saved(lambda: spark.read.schema("p_partkey long, p_name string").json(at), saved)
    empty, also = state.fresh_or_saved(lambda: table(spark, d, "part").where("p_size < 0").select("p_partkey", "p_name"), saved)
    assert why and also
    return unread.intersectAll(empty)


@query(
    "recent_failures",
    f"""SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size - 20 BETWEEN 0 AND 6 THEN DATE '{TODAY}' - CAST(p_size - 20 AS INTEGER) END AS failed FROM part""",
)
def recent_failures(spark: SparkSession, d: str) -> DataFrame:
    """Failures of today and the six days before."""
    at = F.when(F.col("p_size") % 9 == 0, "never").otherwise(F.concat(F.date_sub(F.lit(TODAY).cast("date"), (F.col("p_size") - 20).cast("int")).cast("string"), F.lit("T10:00:00")))
    return table(spark, d, "part").select("p_partkey", state.failed_recently(at, F.lit(TODAY).cast("date")).alias("failed"))


@query(
    "batch_outcomes",
    f"""
WITH i AS (SELECT p_brand AS batch, p_partkey AS item, p_partkey % 10 > 0 AS due FROM part), b AS (SELECT p_brand AS batch, CASE WHEN min(p_size) % 5 > 0 THEN DATE '{TODAY}' - CAST(12 + min(p_size) AS INTEGER) END AS sent FROM part GROUP BY 1), w AS (SELECT batch, bool_or(NOT due) AS waits FROM i GROUP BY 1)
SELECT batch, item, CASE WHEN waits AND coalesce(DATE '{TODAY}' - sent < 14, false) THEN 'held' WHEN due THEN 'settled' ELSE 'dropped' END AS outcome FROM i JOIN b USING (batch) JOIN w USING (batch)
""",
)
def batch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Items of an ended batch: settled if due, dropped if not, held with their batch while one may come due."""
    part = table(spark, d, "part")
    least = part.groupBy("p_brand").agg(F.min("p_size").alias("m"))
    sent = F.when(F.col("m") % 5 > 0, F.date_sub(F.lit(TODAY).cast("date"), (12 + F.col("m")).cast("int")))
    items = part.join(least, "p_brand").select(F.col("p_brand").alias("batch"), F.col("p_partkey").alias("item"), sent.alias("sent"))
    return state.collected(items, part.where("p_partkey % 10 > 0").select(F.col("p_partkey").alias("item")), "batch", "item", "sent", F.lit(TODAY).cast("date")).select("batch", "item", "outcome")


@query(
    "tint_decisions",
    """
WITH s AS (SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN 'a' || p_size % 4 END AS art, p_partkey % 5 > 0 AS readable, CASE WHEN p_size % 7 > 0 THEN p_size % 6 END AS cards, CASE WHEN p_partkey % 4 > 0 THEN '#fff' END AS tint, CASE WHEN p_partkey % 2 = 0 THEN 'art' ELSE 'card' END AS source, 'a' || p_partkey % 4 AS url, CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 6 END AS miss FROM part)
SELECT p_partkey, CASE WHEN tint IS NOT NULL AND source = 'art' AND url = art THEN 'keep' WHEN tint IS NOT NULL AND art IS NULL AND (source = 'card' OR NOT readable) THEN 'keep' WHEN art IS NOT NULL THEN 'art' WHEN coalesce(cards, 0) <= 0 OR coalesce(miss = cards, false) THEN 'none' ELSE 'card' END AS todo FROM s
""",
)
def tint_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Keep a cached tint while what it was made from is the same, else read the official or a card's picture."""
    text = lambda c: c.cast("string")
    art, cards = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("a"), text(F.col("p_size") % 4))), F.when(F.col("p_size") % 7 > 0, F.col("p_size") % 6)
    tint, source = F.when(F.col("p_partkey") % 4 > 0, "#fff"), F.when(F.col("p_partkey") % 2 == 0, "art").otherwise("card")
    return table(spark, d, "part").select("p_partkey", state.tint_decision(art, F.col("p_partkey") % 5 > 0, cards, tint, source, F.concat(F.lit("a"), text(F.col("p_partkey") % 4)), F.when(F.col("p_partkey") % 4 == 0, F.col("p_partkey") % 6)).alias("todo"))


@query(
    "inherited_tints",
    """
WITH RECURSIVE p AS (SELECT p_partkey AS code, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 9 AND p_size = 7 THEN p_partkey WHEN p_partkey % 10 = 5 THEN -1 ELSE p_partkey - 1 END AS parent, p_size FROM part),
r AS (SELECT code, code AS at, 0 AS k FROM p UNION ALL SELECT r.code, p.parent, k + 1 FROM r JOIN p ON p.code = r.at WHERE p.parent IS NOT NULL AND k < 20)
SELECT r.code, '#' || p.p_size AS tint, CASE WHEN r.code = r.at THEN 'card' ELSE 'parent' END AS source FROM r JOIN p ON p.code = r.at WHERE p.parent IS NULL AND p.p_size % 4 > 0
""",
)
def inherited_tints(spark: SparkSession, d: str) -> DataFrame:
    """A set without its own tint takes that of the main set above it, not one above a circle or outside the list."""
    from gleaner.operators import graph

    parent = F.when(F.col("p_partkey") % 10 == 0, None).when((F.col("p_partkey") % 10 == 9) & (F.col("p_size") == 7), F.col("p_partkey")).when(F.col("p_partkey") % 10 == 5, -1).otherwise(F.col("p_partkey") - 1)
    roots = graph.roots(spark, table(spark, d, "part").select(F.col("p_partkey").alias("code"), parent.alias("parent")), "code", "parent")
    own = table(spark, d, "part").where("p_size % 4 > 0 and p_partkey % 10 = 0").select(F.col("p_partkey").alias("root"), F.concat(F.lit("#"), F.col("p_size").cast("string")).alias("tint"))
    return roots.join(own, "root").select(F.col("node").alias("code"), "tint", F.when(F.col("node") == F.col("root"), "card").otherwise("parent").alias("source"))


@query("pages_to_read", """SELECT p_partkey AS page FROM part WHERE p_size % 3 <> 1""")
def pages_to_read(spark: SparkSession, d: str) -> DataFrame:
    """Pages without an extraction of the current version."""
    part = table(spark, d, "part")
    done = part.where("p_size % 3 > 0").select(F.col("p_partkey").alias("page"), (F.col("p_size") % 3).cast("int").alias("version"))
    return state.without_current(part.select(F.col("p_partkey").alias("page")), done, "page", 1)


@query(
    "unresolved_queue",
    """SELECT p_partkey AS deck, CASE WHEN p_size % 4 = 0 THEN 2 ELSE 0 END AS attempts, CASE WHEN p_size % 4 = 0 THEN 'old' ELSE p_name END AS names FROM part WHERE p_size % 4 = 0 OR p_size % 4 = 2""",
)
def unresolved_queue(spark: SparkSession, d: str) -> DataFrame:
    """Decks with unresolved names join the queue once, as never tried; those in it keep their attempts."""
    part = table(spark, d, "part")
    rows = part.select(F.col("p_partkey").alias("deck"), F.when(F.col("p_size") % 2 == 0, F.array("p_name")).otherwise(F.array().cast("array<string>")).alias("names"))
    queue = part.where("p_size % 4 = 0").select(F.col("p_partkey").alias("deck"), F.lit(2).alias("attempts"), F.array(F.lit("old")).alias("names"))
    return state.queued(rows, queue, "deck", "names").select("deck", "attempts", F.array_join("names", ",").alias("names"))


@query(
    "refusal_days",
    """
WITH RECURSIVE e AS (SELECT user_id, ts, event_type IN ('error', 'view', 'click') AS refused, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM (SELECT user_id, ts, min(event_type) AS event_type FROM events GROUP BY 1, 2)),
r AS (SELECT user_id, ts, i, CASE WHEN refused THEN 1 ELSE 0 END AS blocked, CASE WHEN refused THEN ts END AS last FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.ts, e.i, CASE WHEN NOT e.refused THEN 0 WHEN r.last IS NOT NULL AND e.ts - r.last < INTERVAL 12 HOUR AND r.blocked > 0 THEN r.blocked ELSE r.blocked + 1 END, CASE WHEN e.refused THEN e.ts ELSE r.last END FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT user_id, ts, blocked FROM r
""",
)
def refusal_days(spark: SparkSession, d: str) -> DataFrame:
    """Days in a row with refusals, those within twelve hours of the last counting as one."""
    runs = table(spark, d, "events").groupBy("user_id", "ts").agg(F.min("event_type").isin("error", "view", "click").alias("refused"))
    return state.refusals(runs, "user_id", "ts", "refused")


@query("failure_ratio", """SELECT count(*) FILTER (event_type = 'error') AS failed, count(*) AS "all", count(*) FILTER (event_type = 'error') <= 0.02 * count(*) AS fine FROM events""")
def failure_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Whether at most two per cent failed."""
    return state.ratio_guard(table(spark, d, "events").select((F.col("event_type") == "error").alias("failed")), "failed")


def _window(spark: SparkSession, d: str, days: int) -> DataFrame:
    now = F.lit(NOW).cast("timestamp")
    rows = decks(spark, d).where((F.col("ts") >= now - F.make_dt_interval(days=F.lit(days))) & (F.col("ts") <= now) & (F.col("place") < 5))
    n = rows.groupBy("archetype").agg(F.count(F.lit(1)).alias("decks"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    return n.select(F.col("archetype").alias("id"), F.lower("archetype").alias("name"), "decks", F.round(F.col("decks") * 100.0 / total, 1).alias("share"))


_WINDOW = """(SELECT archetype AS id, count(*) AS decks, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS share FROM decks WHERE ts >= TIMESTAMP '{now}' - INTERVAL {days} DAY AND ts <= TIMESTAMP '{now}' AND place < 5 GROUP BY 1)"""


@query(
    "rebuilt_standings",
    f"""
WITH {DECKS}, m AS {_WINDOW.format(now=NOW, days=30)}, w AS {_WINDOW.format(now=NOW, days=7)},
r AS (SELECT archetype AS id, count(*) FILTER (ts >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY AND ts <= TIMESTAMP '{NOW}' AND place <= 8) AS top8, count(*) FILTER (ts >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY AND ts <= TIMESTAMP '{NOW}' AND place = 1) AS wins, count(*) AS results FROM decks WHERE published GROUP BY 1)
SELECT n_name AS id, CASE WHEN m.id IS NOT NULL THEN lower(n_name) WHEN n_nationkey % 2 = 0 THEN 'own ' || n_name ELSE n_name END AS name, m.share AS share_30d, w.share AS share_7d, m.decks AS decks_30d, coalesce(top8, 0) AS top8, coalesce(wins, 0) AS wins, coalesce(results, 0) AS results
FROM nation LEFT JOIN m ON m.id = n_name LEFT JOIN w ON w.id = n_name LEFT JOIN r ON r.id = n_name
""",
)
def rebuilt_standings(spark: SparkSession, d: str) -> DataFrame:
    """The row that standings would have for an archetype past them, from its windows and results."""
    nations = table(spark, d, "nation")
    results = decks(spark, d).where("published").select(F.col("archetype").alias("id"), "ts", "place")
    names = nations.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("id"), F.concat(F.lit("own "), "n_name").alias("name"))
    return standings.rebuilt(nations.select(F.col("n_name").alias("id")), _window(spark, d, 30), _window(spark, d, 7), results, names, NOW)


@query(
    "window_ids",
    f"""WITH {DECKS} SELECT DISTINCT archetype AS id FROM decks WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY AND ts <= TIMESTAMP '{NOW}' AND place < 5""",
)
def window_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids of every window's standings."""
    return standings.ids_of_windows([_window(spark, d, n) for n in (7, 14, 30)], "id")


@query(
    "matched_primers",
    """
WITH r AS (SELECT DISTINCT p_name AS id FROM part WHERE p_size % 3 > 0), p AS (SELECT CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_name || '/' || p_partkey END AS primer, p_name AS archetype, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * CAST(p_size AS INTEGER) AS updated FROM part QUALIFY row_number() OVER (PARTITION BY CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_name || '/' || p_partkey END ORDER BY p_partkey) = 1),
m AS (SELECT p_name AS id, max(p_brand) AS leader FROM part GROUP BY 1), rows AS (SELECT id FROM r UNION SELECT p_brand FROM part WHERE p_size % 2 = 0),
c AS (SELECT archetype AS id, primer, false AS merged, CASE WHEN primer <> archetype THEN 1 ELSE 0 END AS rank, updated FROM p WHERE archetype IN (SELECT id FROM rows) UNION ALL SELECT leader, primer, true, 2, updated FROM p JOIN m ON m.id = p.archetype WHERE archetype NOT IN (SELECT id FROM rows) AND leader IN (SELECT id FROM rows))
SELECT id, primer, merged FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank, updated DESC, primer) = 1
""",
)
def matched_primers(spark: SparkSession, d: str) -> DataFrame:
    """Each archetype's primer: its own, the one named after it first, else one of an archetype merged into it."""
    from gleaner.operators.priority import first_per_key

    part, name = table(spark, d, "part"), F.col("p_name")
    rows = part.where("p_size % 3 > 0").select(name.alias("id")).union(part.where("p_size % 2 = 0").select("p_brand")).distinct()
    listed = part.select(F.when(F.col("p_partkey") % 4 == 0, name).otherwise(F.concat_ws("/", name, F.col("p_partkey").cast("string"))).alias("primer"), name.alias("archetype"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("p_size").cast("int"))).alias("updated"), F.col("p_partkey").alias("pos"))
    merges = part.groupBy(name.alias("id")).agg(F.max("p_brand").alias("leader"))
    return standings.matched_primers(rows, first_per_key(listed, ["primer"], [F.col("pos")]).drop("pos"), merges)


@query(
    "tile_key_cards",
    f"""
WITH {CATALOG}, t AS (SELECT p_brand AS id, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS position, p_size FROM part)
SELECT id, CAST(position AS INTEGER) AS position, p_name AS name, CASE WHEN p_size % 3 > 0 THEN 'own' || p_partkey ELSE 'known ' || slug END AS oracle_id FROM t LEFT JOIN catalog ON slug = trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AND slug NOT LIKE '%ring' WHERE position < 4
""",
)
def tile_key_cards(spark: SparkSession, d: str) -> DataFrame:
    """A tile's first key cards, with ids from the catalog where they have none."""
    from gleaner.functions import text as tx

    card = F.struct(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), tx.ascii_slug(F.col("p_name")).alias("slug"), F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("own"), F.col("p_partkey").cast("string"))).alias("oracle_id"))
    first = priority.top_per_group(table(spark, d, "part"), ["p_brand"], [F.col("p_partkey")], 4)
    tiles = first.groupBy(F.col("p_brand").alias("id")).agg(F.array_sort(F.collect_list(card)).alias("cards"))
    known = catalog(spark, d).where("slug not like '%ring'").select("slug", F.concat(F.lit("known "), "slug").alias("oracle_id"))
    return standings.key_cards(tiles, known, "id", "cards", 4)


@query(
    "deck_numbers",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 't' || p_size WHEN p_size % 3 = 1 AND p_size % 4 > 0 THEN p_brand ELSE p_type END AS number FROM part""",
)
def deck_numbers(spark: SparkSession, d: str) -> DataFrame:
    """A deck's number from its tournament, else its cards, else its course."""
    entries = F.when(F.col("p_size") % 3 == 1, F.array(F.lit(None).cast("string"), F.lit(""), F.when(F.col("p_size") % 4 > 0, F.col("p_brand")), F.when(F.col("p_size") % 4 > 0, F.lit("later")))).otherwise(F.array().cast("array<string>"))
    tournament = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("t"), F.col("p_size").cast("string"))).when(F.col("p_size") % 2 == 0, "")
    return table(spark, d, "part").select("p_partkey", standings.deck_number(tournament, entries, F.col("p_type")).alias("number"))


@query("commander_index", """SELECT c_name AS slug, lower(c_name) AS name, count(*) AS decks FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def commander_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of the pages ever read, with their decks."""
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("decks"), F.max("o_orderdate").alias("checked_at"))
    return standings.pages_index(table(spark, d, "customer").join(n, "c_custkey", "left").select(F.col("c_name").alias("slug"), F.lower("c_name").alias("name"), "decks", "checked_at"))


@query(
    "entity_pages",
    """
WITH i AS (SELECT n_name AS entity, o_orderkey AS pos, o_orderpriority AS page, c_mktsegment AS who, o_orderkey % 7 = 0 AS alone FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
s AS (SELECT entity, page, min(pos) AS first FROM i GROUP BY 1, 2), w AS (SELECT entity, string_agg(DISTINCT who, ',' ORDER BY who) AS mentioned FROM i WHERE NOT alone GROUP BY 1)
SELECT s.entity, string_agg(page || '=' || first, ',' ORDER BY page) AS sources, any_value(mentioned) AS mentioned, any_value(n) AS n_items FROM s LEFT JOIN w USING (entity) JOIN (SELECT entity, count(*) AS n FROM i GROUP BY 1) USING (entity) GROUP BY 1
""",
)
def entity_pages(spark: SparkSession, d: str) -> DataFrame:
    """An entity's page: its sources once each, with the first citation, and everyone it mentions."""
    people = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    key = F.col("o_orderkey")
    items = table(spark, d, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select(F.col("n_name").alias("entity"), key.alias("pos"), F.col("o_orderpriority").alias("page"), key.cast("string").alias("citation"), F.when(key % 7 > 0, F.array("c_mktsegment", F.lit(""))).otherwise(F.array().cast("array<string>")).alias("who"))
    told = F.array_join(F.transform(F.array_sort(F.map_entries("sources")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return standings.entity_pages(items).select("entity", told.alias("sources"), F.array_join("mentioned", ",").alias("mentioned"), "n_items")


@query(
    "bracket_cards",
    f"""
WITH {DECKS}, {LINES}, {_PAGES}, l AS (SELECT b.archetype, b.slug, round(t.rate - b.rate, 9) AS score, substr(b.slug, 1, 1) AS flag FROM page_cards b JOIN page_cards t ON t.archetype = b.archetype AND t.slug = b.slug AND t.page = 'bracket:1' WHERE b.page = 'base' AND t.rate > b.rate),
r AS (SELECT *, row_number() OVER (PARTITION BY archetype, flag ORDER BY score DESC, slug) AS k FROM l), o AS (SELECT *, row_number() OVER (PARTITION BY archetype ORDER BY score DESC, slug) AS pick FROM r WHERE flag <> 's' OR k <= 2)
SELECT archetype, CAST(pick AS INTEGER) AS pick, slug FROM o WHERE pick <= 30
""",
)
def bracket_cards(spark: SparkSession, d: str) -> DataFrame:
    """What sets a bracket apart: cards that its decks play more than all, rule-checked in order of lift, thirty at most."""
    cards = _page_cards(spark, d)
    of = lambda page, c: cards.where(F.col("page") == page).select("archetype", "slug", F.col("rate").alias(c))
    x = of("base", "base").join(of("bracket:1", "own"), ["archetype", "slug"]).where("own > base")
    x = x.select("archetype", "slug", F.round(F.col("own") - F.col("base"), 9).alias("score"), F.substring("slug", 1, 1).alias("flag"), F.lit("any").alias("role"))
    return guides.fill(x, "archetype", "slug", "role", "score", {}, 30, {"s": 2}, "flag").select("archetype", "pick", "slug")
