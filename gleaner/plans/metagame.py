"""Windows, tallies, shares, standings and trends over the bound decks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleaner.functions import classify, numbers, text
from gleaner.operators import priority, tallies, trends, windows
from gleaner.plans.bindings import CATALOG, DECKS, LINES, NOW, catalog, decks, lines
from gleaner.plans.registry import query

_N = f"TIMESTAMP '{NOW}'"
_TRAIL = f"""trail AS (
  SELECT d.*, w AS "window" FROM decks d, (VALUES (7), (14), (30)) v(w) WHERE ts >= {_N} - w * INTERVAL 1 DAY AND CAST(ts AS DATE) <= CAST({_N} AS DATE)
)"""


@query(
    "popular_items_by_window",
    f"""
WITH {DECKS}, {LINES}, {CATALOG}, {_TRAIL},
span AS (SELECT l.deck_id, format, slug, board, qty, "window" FROM trail t JOIN lines l USING (deck_id)),
of AS (SELECT format, "window", count(DISTINCT deck_id) AS n FROM span GROUP BY ALL),
per AS (SELECT format, "window", slug, count(DISTINCT deck_id) AS decks, sum(qty) AS copies FROM span GROUP BY ALL),
x AS (SELECT p.format, p."window", c.kind, p.slug, decks, n AS of_decks, round(decks * 100.0 / n, 1) AS share, round(copies / decks, 1) AS avg_copies
  FROM per p JOIN of o ON p.format = o.format AND p."window" = o."window" JOIN catalog c ON c.slug = p.slug WHERE decks >= 2 AND 100 * decks >= n)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY format, "window", kind ORDER BY decks DESC, avg_copies DESC, slug) AS INTEGER) AS rank FROM x) WHERE rank <= 5
""",
)
def popular_items_by_window(spark: SparkSession, d: str) -> DataFrame:
    """The most played cards of each kind per format and trailing window."""
    recent = windows.trailing(decks(spark, d), "ts", NOW).select("deck_id", "format", "window")
    span = lines(spark, d).join(recent, "deck_id")
    out = tallies.tally(span, ["format", "window"]).where(tallies.floor(F.col("decks"), F.col("of_decks"))).drop("copies")
    out = out.join(catalog(spark, d).select("slug", "kind"), "slug")
    return priority.top_per_group(out, ["format", "window", "kind"], [F.desc("decks"), F.desc("avg_copies"), F.col("slug")], 5)


@query(
    "popular_trend",
    f"""
WITH {DECKS}, {LINES}, p AS (
  SELECT deck_id, format, ts >= {_N} - INTERVAL 30 DAY AND CAST(ts AS DATE) <= CAST({_N} AS DATE) AS recent, ts >= {_N} - INTERVAL 365 DAY AND ts < {_N} - INTERVAL 30 DAY AS base FROM decks
), n AS (SELECT format, count(*) FILTER (recent) AS na, count(*) FILTER (base) AS nb FROM p JOIN (SELECT DISTINCT deck_id FROM lines) USING (deck_id) WHERE recent OR base GROUP BY 1),
h AS (SELECT format, slug, count(DISTINCT deck_id) FILTER (recent) AS a, count(DISTINCT deck_id) FILTER (base) AS b FROM p JOIN lines USING (deck_id) WHERE recent OR base GROUP BY ALL),
x AS (SELECT *, 100 * (a * nb - b * na) AS gap, (a + b) / CAST(na + nb AS DOUBLE) AS q FROM h JOIN n USING (format))
SELECT format, slug, a AS recent_decks, b AS base_decks, CASE WHEN na > 0 AND nb > 0 THEN CASE WHEN abs(gap) > 5 * na * nb AND abs((a / na - b / nb) / sqrt(q * (1 - q) * (1.0 / na + 1.0 / nb))) > 3 THEN CASE WHEN gap > 0 THEN 'up' ELSE 'down' END ELSE 'steady' END END AS trend
FROM x
""",
)
def popular_trend(spark: SparkSession, d: str) -> DataFrame:
    """Recent and baseline periods in one pass, two-proportion trend."""
    ts = F.col("ts")
    flags = decks(spark, d).select("deck_id", "format", windows.within(ts, NOW, 30).alias("recent"), windows.within(ts, NOW, 365, until=30).alias("base")).where("recent or base")
    n_if = lambda c: F.count_distinct(F.when(F.col(c), F.col("deck_id")))
    span = lines(spark, d).join(flags, "deck_id")
    of = span.groupBy("format").agg(n_if("recent").alias("na"), n_if("base").alias("nb"))
    x = span.groupBy("format", "slug").agg(n_if("recent").alias("recent_decks"), n_if("base").alias("base_decks")).join(of, "format")
    return x.select("format", "slug", "recent_decks", "base_decks", trends.proportion_trend(F.col("recent_decks"), F.col("na"), F.col("base_decks"), F.col("nb")).alias("trend"))


@query(
    "metagame_shares",
    f"""
WITH {DECKS}, {_TRAIL} SELECT format, "window", archetype, count(*) AS decks, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY format, "window"), 1) AS share,
CAST(sum(CASE WHEN place <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS top_finishes, CAST(sum(CASE WHEN place = 1 THEN 1 ELSE 0 END) AS BIGINT) AS wins FROM trail GROUP BY 1, 2, 3
""",
)
def metagame_shares(spark: SparkSession, d: str) -> DataFrame:
    """Archetype shares, top finishes and wins per window."""
    rows = windows.trailing(decks(spark, d), "ts", NOW).groupBy("format", "window", "archetype").agg(
        F.count(F.lit(1)).alias("decks"), F.sum((F.col("place") <= 3).cast("bigint")).alias("top_finishes"), F.sum((F.col("place") == 1).cast("bigint")).alias("wins")
    )
    whole = F.sum("decks").over(Window.partitionBy("format", "window"))
    return rows.select("format", "window", "archetype", "decks", numbers.share(F.col("decks"), whole).alias("share"), "top_finishes", "wins")


@query(
    "featured_result",
    f"""WITH {DECKS} SELECT archetype, deck_id, player, place FROM (SELECT *, row_number() OVER (PARTITION BY archetype ORDER BY place, ts DESC, deck_id) AS k FROM decks WHERE published) WHERE k = 1""",
)
def featured_result(spark: SparkSession, d: str) -> DataFrame:
    """The best published result of each archetype, newest of equals."""
    rows = decks(spark, d).where("published").select("archetype", "deck_id", "player", "place", "ts")
    return priority.first_per_key(rows, ["archetype"], [F.col("place"), -F.unix_micros("ts"), F.col("deck_id")]).drop("ts")


@query(
    "mode_first_seen",
    f"""WITH {DECKS} SELECT archetype, kind, n FROM (SELECT archetype, kind, count(*) AS n, row_number() OVER (PARTITION BY archetype ORDER BY count(*) DESC, min(deck_id)) AS k FROM decks GROUP BY 1, 2) WHERE k = 1""",
)
def mode_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent value, of equals the first seen."""
    return priority.mode_first_seen(decks(spark, d), ["archetype"], "kind", "deck_id")


@query(
    "membership_priority_merge",
    f"""
WITH {DECKS}, s AS (
  SELECT deck_id, archetype AS name, 0 AS source, deck_id AS o FROM decks WHERE place = 1 UNION ALL SELECT deck_id, kind, 1, deck_id FROM decks WHERE published UNION ALL SELECT deck_id, player, 2, deck_id FROM decks WHERE place <= 3
) SELECT deck_id, name, source FROM (SELECT *, row_number() OVER (PARTITION BY deck_id ORDER BY source, o) AS k FROM s) WHERE k = 1
""",
)
def membership_priority_merge(spark: SparkSession, d: str) -> DataFrame:
    """One value per deck from the first of three sources that has it."""
    rows = decks(spark, d)
    pick = lambda c, where: rows.where(where).select("deck_id", F.col(c).alias("name"), F.col("deck_id").alias("o"))
    return priority.merged([pick("archetype", "place = 1"), pick("kind", "published"), pick("player", "place <= 3")], ["deck_id"], ["o"]).drop("o")


@query(
    "unassigned_results",
    f"""WITH {DECKS} SELECT deck_id, player FROM decks WHERE place > 3 AND NOT published AND deck_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""",
)
def unassigned_results(spark: SparkSession, d: str) -> DataFrame:
    """Results without a stored main list."""
    main = lines(spark, d).where("board = 'main'").select("deck_id")
    return decks(spark, d).where("place > 3 and not published").join(main, "deck_id", "left_anti").select("deck_id", "player")


@query(
    "unique_name_join",
    """
WITH a AS (SELECT CAST(floor(c_acctbal) AS BIGINT) AS k, c_name FROM customer QUALIFY count(*) OVER (PARTITION BY k) = 1), b AS (SELECT CAST(floor(s_acctbal) AS BIGINT) AS k, s_name FROM supplier QUALIFY count(*) OVER (PARTITION BY k) = 1)
SELECT k, c_name, s_name FROM a JOIN b USING (k)
""",
)
def unique_name_join(spark: SparkSession, d: str) -> DataFrame:
    """A join on keys that occur once on either side; ambiguous keys match nothing."""
    from gleaner.session import table

    keyed = lambda t, c, n: priority.unambiguous(table(spark, d, t).select(F.floor(c).alias("k"), n), "k")
    return keyed("customer", "c_acctbal", "c_name").join(keyed("supplier", "s_acctbal", "s_name"), "k")


@query(
    "kept_archetypes",
    f"""WITH {DECKS}, a AS (SELECT archetype FROM decks GROUP BY 1 HAVING max(ts) >= TIMESTAMP '2001-07-28' - INTERVAL 2 DAY) SELECT archetype, count(*) AS results FROM decks JOIN a USING (archetype) GROUP BY 1""",
)
def kept_archetypes(spark: SparkSession, d: str) -> DataFrame:
    """Groups with a recent row keep all their rows."""
    return windows.kept_by_latest(decks(spark, d), "archetype", "ts", "2001-07-28 00:00:00", 2).groupBy("archetype").agg(F.count(F.lit(1)).alias("results"))


@query(
    "breakouts",
    f"""
WITH {DECKS}, {LINES}, p AS (
  SELECT deck_id, format, ts, place, prestige, ts >= {_N} - INTERVAL 30 DAY AND CAST(ts AS DATE) <= CAST({_N} AS DATE) AS recent, ts >= {_N} - INTERVAL 120 DAY AND ts < {_N} - INTERVAL 30 DAY AS base FROM decks
), s AS (SELECT p.*, slug, board FROM p JOIN lines USING (deck_id) WHERE recent OR base),
n AS (SELECT format, count(DISTINCT deck_id) FILTER (recent) AS na, count(DISTINCT deck_id) FILTER (base) AS nb FROM s GROUP BY 1),
x AS (SELECT format, slug, count(DISTINCT deck_id) FILTER (recent) AS decks, count(DISTINCT deck_id) FILTER (base) AS before, min(ts) FILTER (recent) AS first_seen, count(DISTINCT deck_id) FILTER (recent AND board = 'main') AS main_decks, max(prestige) FILTER (recent) AS best_prestige FROM s GROUP BY ALL)
SELECT format, slug, decks, before, first_seen, main_decks, best_prestige, round(decks * 100.0 / na, 1) AS share FROM x JOIN n USING (format) WHERE nb >= 20 AND na > 0 AND decks >= 4 AND 100 * decks >= na AND decks * nb >= 1.3 * before * na
""",
)
def breakouts(spark: SparkSession, d: str) -> DataFrame:
    """Cards whose recent share outgrew the baseline, only with enough evidence."""
    ts = F.col("ts")
    flags = decks(spark, d).select("deck_id", "format", "ts", "prestige", windows.within(ts, NOW, 30).alias("recent"), windows.within(ts, NOW, 120, until=30).alias("base")).where("recent or base")
    span = lines(spark, d).join(flags, "deck_id")
    n_if = lambda c: F.count_distinct(F.when(c, F.col("deck_id")))
    recent, base = F.col("recent"), F.col("base")
    of = span.groupBy("format").agg(n_if(recent).alias("na"), n_if(base).alias("nb"))
    per = span.groupBy("format", "slug").agg(
        n_if(recent).alias("decks"), n_if(base).alias("before"), F.min(F.when(recent, ts)).alias("first_seen"), n_if(recent & (F.col("board") == "main")).alias("main_decks"), F.max(F.when(recent, F.col("prestige"))).alias("best_prestige")
    )
    x = per.join(of, "format").where("nb >= 20 and na > 0")
    out = x.where(trends.breakout(F.col("decks"), F.col("na"), F.col("before"), F.col("nb"), times=F.lit(1.3)))
    return out.select("format", "slug", "decks", "before", "first_seen", "main_decks", "best_prestige", numbers.share(F.col("decks"), F.col("na")).alias("share"))


@query(
    "hands",
    f"""WITH {DECKS}, {LINES} SELECT * FROM (SELECT archetype, slug, CAST(sum(qty) AS BIGINT) AS copies, CAST(row_number() OVER (PARTITION BY archetype ORDER BY sum(qty) DESC, slug) AS INTEGER) AS rank FROM decks JOIN lines USING (deck_id) GROUP BY 1, 2) WHERE rank <= 5""",
)
def hands(spark: SparkSession, d: str) -> DataFrame:
    """The five cards of an archetype with the most copies."""
    return tallies.hand(lines(spark, d).join(decks(spark, d).select("deck_id", "archetype"), "deck_id"), ["archetype"])


@query(
    "archetype_profiles",
    f"""
WITH {DECKS}, {LINES}, v AS (SELECT archetype, deck_id, slug, least(sum(qty), 4) AS w FROM decks JOIN lines USING (deck_id) GROUP BY ALL), n AS (SELECT archetype, count(DISTINCT deck_id) AS decks FROM v GROUP BY 1)
SELECT archetype, slug, round(sum(w) / decks, 6) AS w, decks FROM v JOIN n USING (archetype) GROUP BY archetype, slug, decks
""",
)
def archetype_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Average capped copies over all decks of the archetype."""
    out = tallies.profile(lines(spark, d).join(decks(spark, d).select("deck_id", "archetype"), "deck_id"), ["archetype"])
    return out.withColumn("w", F.round("w", 6))


@query(
    "card_archetype_rollup",
    f"""
WITH {DECKS}, {LINES}, x AS (SELECT slug, format, archetype, count(DISTINCT deck_id) AS decks, CAST(sum(qty) AS BIGINT) AS copies, round(sum(qty) / count(DISTINCT deck_id), 1) AS avg_copies, string_agg(DISTINCT CAST(deck_id AS VARCHAR), ',') AS ids FROM decks JOIN lines USING (deck_id) GROUP BY ALL),
f AS (SELECT slug, format, archetype, deck_id FROM (SELECT slug, format, archetype, deck_id, row_number() OVER (PARTITION BY slug, format, archetype ORDER BY deck_id) AS k FROM (SELECT DISTINCT slug, format, archetype, deck_id FROM decks JOIN lines USING (deck_id))) WHERE k <= 5),
g AS (SELECT slug, format, archetype, string_agg(CAST(deck_id AS VARCHAR), ',' ORDER BY deck_id) AS first_decks FROM f GROUP BY ALL)
SELECT slug, format, archetype, decks, copies, avg_copies, first_decks FROM x JOIN g USING (slug, format, archetype) QUALIFY row_number() OVER (PARTITION BY slug, format ORDER BY decks DESC, archetype) <= 3
""",
)
def card_archetype_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Card by format by archetype, the first five decks, top archetypes only."""
    span = lines(spark, d).join(decks(spark, d).select("deck_id", "format", "archetype"), "deck_id")
    per_deck = span.groupBy("slug", "format", "archetype", "deck_id").agg(F.sum("qty").alias("qty"))
    x = per_deck.groupBy("slug", "format", "archetype").agg(F.count(F.lit(1)).alias("decks"), F.sum("qty").alias("copies"))
    x = priority.top_per_group(x, ["slug", "format"], [F.desc("decks"), F.col("archetype")], 3).drop("rank")
    first = priority.top_per_group(per_deck, ["slug", "format", "archetype"], [F.col("deck_id")], 5)
    ids = first.groupBy("slug", "format", "archetype").agg(F.array_join(F.array_sort(F.collect_list("deck_id")).cast("array<string>"), ",").alias("first_decks"))
    return x.join(ids, ["slug", "format", "archetype"]).withColumn("avg_copies", F.round(F.col("copies") / F.col("decks"), 1))


@query(
    "apportioned_shares",
    f"""
WITH {DECKS}, x AS (SELECT format, archetype, count(*) AS decks FROM decks GROUP BY 1, 2), y AS (SELECT *, decks * 1000 / CAST(sum(decks) OVER (PARTITION BY format) AS DOUBLE) AS q FROM x),
z AS (SELECT *, CAST(floor(q) AS BIGINT) AS f, row_number() OVER (PARTITION BY format ORDER BY round(q - floor(q), 9) DESC, archetype) AS r FROM y)
SELECT format, archetype, decks, CAST(f + CASE WHEN r <= 1000 - sum(f) OVER (PARTITION BY format) THEN 1 ELSE 0 END AS BIGINT) AS units FROM z
""",
)
def apportioned_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares in tenths of a percent that add up to exactly 100.0 per format."""
    counts = decks(spark, d).groupBy("format", "archetype").agg(F.count(F.lit(1)).alias("decks"))
    return tallies.apportioned(counts, ["format"], "decks", "archetype")


@query(
    "color_weights",
    f"""
WITH {DECKS}, {LINES}, {CATALOG}, x AS (SELECT archetype, color, sum(qty) AS mass FROM decks JOIN lines USING (deck_id) JOIN catalog USING (slug) WHERE board = 'main' GROUP BY 1, 2)
SELECT archetype, color, CAST(mass AS BIGINT) AS mass, round(mass / sum(mass) OVER (PARTITION BY archetype), 6) AS weight FROM x
""",
)
def color_weights(spark: SparkSession, d: str) -> DataFrame:
    """Colour mass per copy of the main boards, normalised per archetype."""
    span = lines(spark, d).where("board = 'main'").join(decks(spark, d).select("deck_id", "archetype"), "deck_id").join(catalog(spark, d).select("slug", "color"), "slug")
    mass = span.groupBy("archetype", "color").agg(F.sum("qty").alias("mass"))
    return mass.withColumn("weight", F.round(F.col("mass") / F.sum("mass").over(Window.partitionBy("archetype")), 6))


@query(
    "merged_group_rollup",
    f"""
WITH {DECKS}, t AS (SELECT format, archetype, count(*) AS decks, CASE WHEN min(place) = 1 THEN sum(place) END AS score FROM decks GROUP BY 1, 2), m AS (SELECT DISTINCT archetype, 'NATION_' || CAST(CAST(substr(archetype, 8) AS INTEGER) // 2 * 2 AS VARCHAR) AS leader FROM decks)
SELECT format, coalesce(leader, archetype) AS leader, CAST(sum(decks) AS BIGINT) AS decks, CAST(CASE WHEN count(score) = count(*) THEN sum(score) END AS BIGINT) AS score, count(*) AS members FROM t LEFT JOIN m USING (archetype) GROUP BY 1, 2
""",
)
def merged_group_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Members summed under their leader; a sum with an unknown part is unknown."""
    rows = decks(spark, d)
    tiles = rows.groupBy("format", "archetype").agg(F.count(F.lit(1)).alias("decks"), F.when(F.min("place") == 1, F.sum("place")).alias("score"))
    number = F.expr("cast(substr(archetype, 8) as int) div 2 * 2")
    leaders = rows.select("archetype").distinct().withColumn("leader", F.concat(F.lit("NATION_"), number.cast("string")))
    joined = tiles.join(leaders, "archetype", "left")
    return joined.groupBy("format", F.coalesce("leader", "archetype").alias("leader")).agg(
        F.sum("decks").alias("decks"), F.when(F.count("score") == F.count(F.lit(1)), F.sum("score")).alias("score"), F.count(F.lit(1)).alias("members")
    )


@query(
    "standings",
    f"""
WITH {DECKS} SELECT format, deck_id, player, place, CASE WHEN place <= 3 THEN CAST(place AS VARCHAR) || CASE place WHEN 1 THEN 'st' WHEN 2 THEN 'nd' ELSE 'rd' END WHEN place <= 4 THEN 'Top 4' ELSE 'Top 8' END AS finish, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY format ORDER BY place, prestige DESC, ts DESC, deck_id) AS rank FROM decks WHERE ts >= {_N} - INTERVAL 30 DAY AND CAST(ts AS DATE) <= CAST({_N} AS DATE)) WHERE rank <= 16
""",
)
def standings(spark: SparkSession, d: str) -> DataFrame:
    """The first sixteen of each format by five keys, finishes as text."""
    rows = decks(spark, d).where(windows.within(F.col("ts"), NOW, 30))
    top = priority.top_per_group(rows, ["format"], [F.col("place"), F.desc("prestige"), F.desc("ts"), F.col("deck_id")], 16)
    return top.select("format", "deck_id", "player", "place", classify.bucket(F.col("place")).alias("finish"), "rank")


@query(
    "places_of_finishes",
    """
SELECT o_orderkey, finish, CASE WHEN regexp_matches(finish, '^[0-9]+(st|nd|rd|th)$') THEN CAST(regexp_extract(finish, '^[0-9]+') AS INTEGER) WHEN finish LIKE 'Top %' THEN CAST(substr(finish, 5) AS INTEGER) // 2 + 1 END AS place
FROM (SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN '1st' WHEN '2' THEN '2nd' WHEN '3' THEN 'Top 4' WHEN '4' THEN 'Top 8' ELSE '5-0' END AS finish FROM orders)
""",
)
def places_of_finishes(spark: SparkSession, d: str) -> DataFrame:
    """Places of ordinals and 'Top N'; league records have none."""
    from gleaner.session import table

    finish = classify.first_match(F.col("o_orderpriority"), [("^1", "1st"), ("^2", "2nd"), ("^3", "Top 4"), ("^4", "Top 8")], "5-0")
    rows = table(spark, d, "orders").select("o_orderkey", finish.alias("finish"))
    return rows.withColumn("place", classify.place(F.col("finish")))


@query(
    "tenths_trend",
    f"""
WITH {DECKS}, x AS (SELECT format, archetype, round(100.0 * count(*) FILTER (ts >= {_N} - INTERVAL 90 DAY AND ts < {_N}) / sum(count(*) FILTER (ts >= {_N} - INTERVAL 90 DAY AND ts < {_N})) OVER (PARTITION BY format), 1) AS now_share,
  round(100.0 * count(*) FILTER (ts >= {_N} - INTERVAL 180 DAY AND ts < {_N} - INTERVAL 90 DAY) / sum(count(*) FILTER (ts >= {_N} - INTERVAL 180 DAY AND ts < {_N} - INTERVAL 90 DAY)) OVER (PARTITION BY format), 1) AS before_share FROM decks GROUP BY 1, 2)
SELECT format, archetype, now_share, before_share, CASE WHEN round(now_share * 10) - round(before_share * 10) > 10 THEN 'up' WHEN round(now_share * 10) - round(before_share * 10) < -10 THEN 'down' ELSE 'steady' END AS trend FROM x
""",
)
def tenths_trend(spark: SparkSession, d: str) -> DataFrame:
    """Change of shares by more than a point, in tenths."""
    ts, now = F.col("ts"), windows.at(NOW)
    recent = (ts >= now - F.expr("interval 90 days")) & (ts < now)
    base = (ts >= now - F.expr("interval 180 days")) & (ts < now - F.expr("interval 90 days"))
    x = decks(spark, d).groupBy("format", "archetype").agg(F.count_if(recent).alias("a"), F.count_if(base).alias("b"))
    w = Window.partitionBy("format")
    y = x.select("format", "archetype", numbers.share(F.col("a"), F.sum("a").over(w)).alias("now_share"), numbers.share(F.col("b"), F.sum("b").over(w)).alias("before_share"))
    return y.withColumn("trend", trends.tenths_trend(F.col("now_share"), F.col("before_share")))


@query(
    "diversified_top",
    f"""
WITH {DECKS}, {LINES}, x AS (SELECT format, slug, CAST(sum(qty) AS BIGINT) AS copies FROM decks JOIN lines USING (deck_id) GROUP BY 1, 2), y AS (SELECT *, row_number() OVER (ORDER BY copies DESC, format, slug) AS r, row_number() OVER (PARTITION BY format ORDER BY copies DESC, slug) AS own FROM x),
z AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN own = 1 THEN 0 ELSE 1 END, r) AS pick FROM y) SELECT format, slug, copies, row_number() OVER (ORDER BY r) AS rank FROM z WHERE pick <= 12
""",
)
def diversified_top(spark: SparkSession, d: str) -> DataFrame:
    """The best of each format first, then the best of the rest, shown in rank order."""
    from gleaner.operators.topk import diversified

    x = lines(spark, d).join(decks(spark, d).select("deck_id", "format"), "deck_id").groupBy("format", "slug").agg(F.sum("qty").alias("copies"))
    return diversified(x, "format", [F.desc("copies"), F.col("slug")], [F.desc("copies"), F.col("format"), F.col("slug")], 12)


@query(
    "duplicate_events",
    f"""
WITH {DECKS}, e AS (SELECT format, CAST(ts AS DATE) AS day, kind, count(*) AS n, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS sig, min(deck_id) AS event FROM decks GROUP BY 1, 2, 3)
SELECT event, format, day, kind, sig FROM e WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY day, sig ORDER BY format, kind) > 1
""",
)
def duplicate_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of one day with the same standings as another; the first stays, these go."""
    e = decks(spark, d).groupBy("format", F.to_date("ts").alias("day"), "kind").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("place")).cast("array<string>"), ",").alias("sig"), F.min("deck_id").alias("event")
    )
    w = Window.partitionBy("day", "sig").orderBy("format", "kind")
    return e.where("n >= 2").withColumn("k", F.row_number().over(w)).where("k > 1").select("event", "format", "day", "kind", "sig")


@query(
    "card_kinds",
    """
SELECT p_partkey, CASE WHEN list_contains(string_split(p_name, ' '), 'widget') THEN 'widget' WHEN list_contains(string_split(p_name, ' '), 'ring') THEN 'ring' WHEN list_contains(string_split(p_name, ' '), 'rod') THEN 'rod' ELSE 'Other' END AS kind,
 len(list_distinct(regexp_extract_all(lower(p_name), '[a-z]{4,}')))::INTEGER AS long_words FROM part
""",
)
def card_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The first listed kind among a name's words; its distinct long words."""
    from gleaner.session import table

    return table(spark, d, "part").select("p_partkey", classify.listed_first(F.split("p_name", " "), ["widget", "ring", "rod"]).alias("kind"), F.size(text.words(F.col("p_name"), 4)).alias("long_words"))


@query(
    "rolled_up_finishes",
    f"""WITH {DECKS} SELECT format, archetype, count(*) AS decks, CAST(sum(CASE WHEN place = 1 THEN 1 ELSE 0 END) AS BIGINT) AS wins, CAST(grouping(format) + grouping(archetype) AS INTEGER) AS level FROM decks GROUP BY ROLLUP (format, archetype)""",
)
def rolled_up_finishes(spark: SparkSession, d: str) -> DataFrame:
    """A07 A37 A42, beyond parity: totals at every level by ROLLUP."""
    return decks(spark, d).rollup("format", "archetype").agg(
        F.count(F.lit(1)).alias("decks"), F.sum((F.col("place") == 1).cast("bigint")).alias("wins"), (F.grouping("format").cast("int") + F.grouping("archetype").cast("int")).alias("level")
    )
