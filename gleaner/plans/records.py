"""Citations, entries, overlays, audits and composed documents over the bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleaner.functions import dates, text as tx
from gleaner.operators import priority, texts
from gleaner.plans.bindings import CATALOG, DECKS, LINES, PRICES, catalog, decks, lines, prices
from gleaner.plans.registry import query
from gleaner.session import table
from gleaner.sources import history
from gleaner.sources.jsonlines import canonical


@query(
    "citations",
    """
WITH c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '[?#].*$', ''), '^[a-z]+://(www\\.|m\\.)?', ''), '/+$', '') AS work, contains(url, '.example.com') AS official FROM pages)
SELECT split_part(work, '/', 1) AS publisher, count(*) AS works, bool_or(NOT official) AS credit FROM c GROUP BY 1
""",
)
def citations(spark: SparkSession, d: str) -> DataFrame:
    """Citations by publisher, and whether a licence credit is due."""
    c = table(spark, d, "pages").select(canonical(F.col("url")).alias("work"), F.contains("url", F.lit(".example.com")).alias("official"))
    return c.groupBy(F.split_part("work", F.lit("/"), F.lit(1)).alias("publisher")).agg(F.count(F.lit(1)).alias("works"), F.bool_or(~F.col("official")).alias("credit"))


@query(
    "event_entries",
    f"""
WITH {DECKS}, f AS (SELECT deck_id, place AS final FROM decks WHERE published) SELECT d.deck_id, format, coalesce(final, prestige + 5) AS place, row_number() OVER (PARTITION BY format, CAST(ts AS DATE) ORDER BY coalesce(final, prestige + 5), d.deck_id)::INTEGER AS position FROM decks d LEFT JOIN f USING (deck_id)
""",
)
def event_entries(spark: SparkSession, d: str) -> DataFrame:
    """Final ranks override standings; entries of an event by place, then as listed."""
    rows = decks(spark, d)
    final = rows.where("published").select("deck_id", F.col("place").alias("final"))
    x = rows.select("deck_id", "format", "ts", "prestige").join(final, "deck_id", "left").withColumn("place", F.coalesce("final", F.col("prestige") + 5))
    w = Window.partitionBy("format", F.to_date("ts")).orderBy("place", "deck_id")
    return x.select("deck_id", "format", "place", F.row_number().over(w).alias("position"))


@query(
    "longest_prefixes",
    """
WITH n AS (SELECT DISTINCT p_brand AS name FROM part), t AS (SELECT p_partkey, p_brand || '5-' || p_name AS label FROM part)
SELECT p_partkey, label, name FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY length(name) DESC) AS k FROM t JOIN n ON starts_with(label, name)) WHERE k = 1
""",
)
def longest_prefixes(spark: SparkSession, d: str) -> DataFrame:
    """The longest known name at the head of a text."""
    part = table(spark, d, "part")
    rows = part.select("p_partkey", F.concat("p_brand", F.lit("5-"), "p_name").alias("label"))
    return texts.longest_prefix(rows, part.select(F.col("p_brand").alias("name")), "label", "name").select("p_partkey", "label", "name")


@query(
    "keys_anywhere",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) || ',' || event_type AS found FROM events""",
)
def keys_anywhere(spark: SparkSession, d: str) -> DataFrame:
    """Values of a key at any depth."""
    nested = F.concat(F.lit('{"a": [{"k": '), F.get_json_object("props", "$.k"), F.lit('}, {"b": {"k": "'), F.col("event_type"), F.lit('"}}], "x": "k"}'))
    return table(spark, d, "events").select("event_id", F.array_join(texts.key_values(nested, "k"), ",").alias("found"))


@query(
    "format_headlines",
    f"""
WITH {DECKS}, {LINES}, s AS (SELECT format, archetype, slug, count(DISTINCT deck_id) AS n FROM decks JOIN lines USING (deck_id) GROUP BY 1, 2, 3), c AS (SELECT format, slug, sum(n) AS n FROM s GROUP BY 1, 2), b AS (SELECT format, slug, n FROM (SELECT *, row_number() OVER (PARTITION BY format ORDER BY n DESC, slug) AS k FROM c) WHERE k = 1)
SELECT format, slug, CAST(b.n AS BIGINT) AS decks, string_agg(archetype, ', ' ORDER BY x.n DESC, archetype) AS archetypes FROM b JOIN (SELECT *, row_number() OVER (PARTITION BY format, slug ORDER BY n DESC, archetype) AS k FROM s) x USING (format, slug) WHERE k <= 3 GROUP BY 1, 2, 3
""",
)
def format_headlines(spark: SparkSession, d: str) -> DataFrame:
    """Each format's busiest card with the archetypes that play it most."""
    s = lines(spark, d).select("deck_id", "slug").distinct().join(decks(spark, d).select("deck_id", "format", "archetype"), "deck_id").groupBy("format", "archetype", "slug").agg(F.count(F.lit(1)).alias("n"))
    busiest = priority.first_per_key(s.groupBy("format", "slug").agg(F.sum("n").alias("decks")), ["format"], [-F.col("decks"), F.col("slug")])
    top = priority.top_per_group(s.join(busiest, ["format", "slug"]), ["format", "slug", "decks"], [F.desc("n"), F.col("archetype")], 3)
    names = F.transform(F.array_sort(F.collect_list(F.struct("rank", "archetype"))), lambda x: x["archetype"])
    return top.groupBy("format", "slug", "decks").agg(F.array_join(names, ", ").alias("archetypes"))


@query(
    "deck_audit",
    f"""
WITH {DECKS}, {LINES}, {CATALOG}, q AS (SELECT deck_id, coalesce(sum(qty) FILTER (board = 'main'), 0) AS main, max(qty) AS most, count(*) FILTER (c.slug IS NULL) AS unknown, count(*) FILTER (c.kind = 'PROMO') AS promo FROM lines LEFT JOIN catalog c USING (slug) GROUP BY 1)
SELECT * FROM (SELECT deck_id, concat_ws(',', CASE WHEN main < 60 THEN 'few cards' END, CASE WHEN most > 60 THEN 'many copies' END, CASE WHEN unknown > 0 THEN 'unknown card' END, CASE WHEN promo > 3 THEN 'too many promos' END) AS problems FROM q JOIN decks USING (deck_id) WHERE published) WHERE problems <> ''
""",
)
def deck_audit(spark: SparkSession, d: str) -> DataFrame:
    """Problems of published lists, all at once."""
    x = lines(spark, d).join(catalog(spark, d).select("slug", "kind"), "slug", "left").join(decks(spark, d).where("published").select("deck_id"), "deck_id")
    q = x.groupBy("deck_id").agg(
        F.coalesce(F.sum(F.when(F.col("board") == "main", F.col("qty"))), F.lit(0)).alias("main"), F.max("qty").alias("most"), F.count_if(F.col("kind").isNull()).alias("unknown"), F.count_if(F.col("kind") == "PROMO").alias("promo")
    )
    rules = {"few cards": F.col("main") < 60, "many copies": F.col("most") > 60, "unknown card": F.col("unknown") > 0, "too many promos": F.col("promo") > 3}
    problems = F.array_join(F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())), lambda p: p.isNotNull()), ",")
    return q.select("deck_id", problems.alias("problems")).where("problems <> ''")


@query(
    "overlaid_answers",
    f"""
WITH {DECKS}, o AS (SELECT format, archetype, min(player) AS answer FROM decks WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2), n AS (SELECT format, archetype, max(player) AS answer FROM decks WHERE ts >= TIMESTAMP '1998-01-01' GROUP BY 1, 2)
SELECT coalesce(n.format, o.format) AS format, coalesce(n.archetype, o.archetype) AS archetype, coalesce(n.answer, o.answer, 'none') AS answer, n.answer IS NOT NULL AS rewritten FROM n FULL JOIN o ON n.format = o.format AND n.archetype = o.archetype
""",
)
def overlaid_answers(spark: SparkSession, d: str) -> DataFrame:
    """New answers by composite key over the old ones; the others stay."""
    rows = decks(spark, d)
    old = rows.where("ts < '1998-01-01'").groupBy("format", "archetype").agg(F.min("player").alias("old"))
    new = rows.where("ts >= '1998-01-01'").groupBy("format", "archetype").agg(F.max("player").alias("new"))
    return new.join(old, ["format", "archetype"], "full").select("format", "archetype", F.coalesce("new", "old", F.lit("none")).alias("answer"), F.col("new").isNotNull().alias("rewritten"))


@query(
    "prunable_parts",
    """WITH c AS (SELECT DISTINCT l_partkey AS p FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-11-01'), b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-10-25' AND l_shipdate < TIMESTAMP '2001-11-01') SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT p FROM c) AND p_partkey NOT IN (SELECT l_partkey FROM b)""",
)
def prunable_parts(spark: SparkSession, d: str) -> DataFrame:
    """What neither the current nor the previous manifest names."""
    rows = table(spark, d, "lineitem").where("l_shipdate >= '2001-10-25'").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(rows, "p_partkey", "left_anti")


@query(
    "keyword_examples",
    """
WITH k AS (SELECT split_part(p_name, ' ', 2) AS keyword, p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_size END AS rank, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS reminder FROM part)
SELECT keyword, arg_min(p_partkey, (coalesce(rank, 999), p_partkey)) AS example, arg_min(reminder, (coalesce(rank, 999), p_partkey)) FILTER (reminder IS NOT NULL) AS reminder FROM k GROUP BY 1
""",
)
def keyword_examples(spark: SparkSession, d: str) -> DataFrame:
    """Examples by rank with unranked last, and the first reminder text there is."""
    k = table(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("keyword"), "p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("rank"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).alias("reminder"))
    order = F.struct(F.coalesce("rank", F.lit(999)), "p_partkey")
    return k.groupBy("keyword").agg(F.min_by("p_partkey", order).alias("example"), F.min_by("reminder", F.when(F.col("reminder").isNotNull(), order)).alias("reminder"))


@query(
    "name_folds",
    """SELECT p_partkey, replace(replace(p_name, 'a', 'а'), 'o', 'о') AS masked, p_name AS plain FROM part""",
)
def name_folds(spark: SparkSession, d: str) -> DataFrame:
    """Look-alike letters read as the Latin ones."""
    masked = F.translate("p_name", "ao", "ао")
    return table(spark, d, "part").select("p_partkey", masked.alias("masked"), tx.nfkc(tx.unmask(masked)).alias("plain"))


@query(
    "history_round_trip",
    f"""WITH {PRICES} SELECT lpad(lower(to_hex(printing)), 32, '0') AS printing, day, cents FROM prices""",
)
def history_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Prices encoded as binary histories and decoded again."""
    key = F.lower(F.lpad(F.hex("printing"), 32, "0"))
    points = prices(spark, d).select(key.alias("printing"), F.lit(0).alias("finish"), dates.day_number(F.col("day")).alias("day"), "cents")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), table(spark, d, "lineitem").count() // 500_000)  # a part is one task's frame
    out = history.points(history.files(points, 9000, 12000, parts))
    return out.select(F.replace("printing", F.lit("-"), F.lit("")).alias("printing"), "day", "cents")


@query(
    "entry_maps",
    """SELECT p_brand AS product, p_partkey AS id, p_size AS size FROM part""",
)
def entry_maps(spark: SparkSession, d: str) -> DataFrame:
    """Entries of a JSON object by their keys, each parsed with its own schema."""
    part = table(spark, d, "part").select("p_brand", "p_type", F.map_from_arrays(F.array(F.col("p_partkey").cast("string")), F.array(F.struct(F.col("p_size").alias("size"), F.col("p_name").alias("name")))).alias("m"))
    bodies = part.select("p_brand", F.to_json("m").alias("body"))
    return bodies.select(F.col("p_brand").alias("product"), F.explode(F.from_json("body", "map<string,struct<size:int,name:string>>")).alias("id", "e")).select("product", F.col("id").cast("bigint").alias("id"), "e.size")


@query(
    "identities",
    """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'W' WHEN p_size % 4 < 3 THEN array_to_string(list_filter(['W', 'U', 'B', 'R', 'G'], lambda c: list_contains(list_distinct([['W', 'U', 'B', 'R', 'G'][p_size % 5 + 1], ['W', 'U', 'B', 'R', 'G'][CAST(p_partkey % 5 AS INTEGER) + 1]]), c)), '') END AS identity FROM part""",
)
def identities(spark: SparkSession, d: str) -> DataFrame:
    """A page's own colours, else the union of both halves in order, else unknown."""
    wheel = F.array(*map(F.lit, "WUBRG"))
    k, at = F.col("p_size") % 4, lambda i: F.element_at(wheel, i.cast("int") + 1)
    halves = F.array_union(F.array(at(F.col("p_size") % 5)), F.array(at(F.col("p_partkey") % 5)))
    own, both = F.when(k == 0, F.array(F.lit("W"))), F.when(k < 3, F.filter(wheel, lambda c: F.array_contains(halves, c)))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.coalesce(own, both), "").alias("identity"))
