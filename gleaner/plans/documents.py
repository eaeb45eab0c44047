"""Parsing, text, scalar, document and streaming queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleaner.functions import dates, numbers, text as tx
from gleaner.operators import graph, texts
from gleaner.plans.bindings import DECKS, LINES, decks, lines
from gleaner.plans.registry import query
from gleaner.session import table
from gleaner.sources import html, images, jsonlines, sinks
from gleaner.streaming import seen, windows as streams


@query(
    "parsed_deck_lists",
    f"""WITH {LINES} SELECT deck_id, board, name, qty AS quantity FROM lines""",
)
def parsed_deck_lists(spark: SparkSession, d: str) -> DataFrame:
    """Plain deck lists parsed back into boards, names and quantities."""
    rows = lines(spark, d)
    board = lambda b: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("board") == b, F.struct("name", "qty")))), lambda x: F.concat_ws(" ", x["qty"].cast("string"), x["name"])), "\n")
    listed = rows.groupBy("deck_id").agg(board("main").alias("m"), board("side").alias("s")).select("deck_id", F.concat(F.lit("1 marker\r\n"), F.col("m"), F.lit("\nSideboard\n"), F.col("s")).alias("body"))
    return texts.deck_lines(listed, "deck_id", "body").where("problem is null and name <> 'marker'").select("deck_id", "board", "name", "quantity")


@query(
    "list_problems",
    """SELECT p_partkey, 'unknown line' AS problem FROM part WHERE p_size % 7 = 0""",
)
def list_problems(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are no card are reported, not lost."""
    body = F.concat(F.lit("4 "), F.col("p_name"), F.lit("\n"), F.when(F.col("p_size") % 7 == 0, "<html>").otherwise("2 plate"))
    return texts.deck_lines(table(spark, d, "part").select("p_partkey", body.alias("body")), "p_partkey", "body").where("problem is not null").select("p_partkey", "problem")


@query(
    "embedded_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def embedded_json(spark: SparkSession, d: str) -> DataFrame:
    """The JSON object after a script's marker."""
    page = F.concat(F.lit("<script>window.DATA = "), F.col("props"), F.lit("; track();</script>"))
    return table(spark, d, "events").select("event_id", jsonlines.embedded(page, "window\\.DATA =", "k int")["k"].alias("k"))


@query(
    "page_links",
    """SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages""",
)
def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Distinct links of a page."""
    return table(spark, d, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))).alias("href"))


@query(
    "canonical_pages",
    """SELECT key, max(page_id) AS page_id FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '[?#].*$', ''), '^[a-z]+://(www\\.|m\\.)?', ''), '/+$', '') AS key FROM pages) GROUP BY 1""",
)
def canonical_pages(spark: SparkSession, d: str) -> DataFrame:
    """The last snapshot of each canonical address."""
    return table(spark, d, "pages").groupBy(jsonlines.canonical(F.col("url")).alias("key")).agg(F.max("page_id").alias("page_id"))


@query("page_paragraphs")
def page_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs with sections and scenes by a real tokenizer."""
    return html.paragraphs(table(spark, d, "pages"), "page_id", "html", least=20)


@query("longest_paragraph")
def longest_paragraph(spark: SparkSession, d: str) -> DataFrame:
    """The longest paragraph of a page."""
    rows = html.paragraphs(table(spark, d, "pages"), "page_id", "html").where("kind = 'p'")
    return rows.groupBy("page_id").agg(F.max_by("text", F.struct(F.length("text"), -F.col("pos"))).alias("text"))


@query(
    "document_lines",
    """SELECT doc_id, i - 1 AS pos, s[i] AS line FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS s FROM documents)) WHERE trim(s[i]) <> ''""",
)
def document_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a text in order, blank ones left out."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "line")).where("trim(line) <> ''").withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "carried_headings",
    """
WITH l AS (SELECT doc_id, i, s[i] AS line FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))),
h AS (SELECT *, max(CASE WHEN regexp_matches(line, '^[AEIO]') THEN i END) OVER w AS c, max(CASE WHEN regexp_matches(line, '^T') THEN i END) OVER w AS s FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i))
SELECT h.doc_id, h.i - 1 AS pos, a.line AS chapter, CASE WHEN h.c IS NOT NULL AND h.s >= h.c OR h.c IS NULL AND h.s IS NOT NULL THEN b.line END AS section FROM h LEFT JOIN l a ON a.doc_id = h.doc_id AND a.i = h.c LEFT JOIN l b ON b.doc_id = h.doc_id AND b.i = h.s
""",
)
def carried_headings(spark: SparkSession, d: str) -> DataFrame:
    """Each line with the headings above it; a heading ends those of lower levels."""
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    out = texts.line_tree(rows, "doc_id", "pos", "line", {"chapter": "^[AEIO]", "section": "^T"})
    return out.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "chapter", "section")


@query(
    "retrieved_facts",
    """
WITH s AS (SELECT doc_id, lang, source, list_distinct([left(w, 5) FOR w IN list_distinct(regexp_extract_all(lower(text), '[a-z]{1,}')) IF length(w) >= 3]) AS st FROM documents),
h AS (SELECT *, len(list_intersect(st, ['there', 'wheth', 'tions', 'heren', 'quere', 'schen', 'erver', 'mento'])) AS hits FROM s), r AS (SELECT *, 3 * hits + CASE source WHEN 'src0' THEN 2 WHEN 'src1' THEN 1 ELSE 0 END AS score FROM h WHERE hits > 0)
SELECT source, doc_id, CAST(hits AS INTEGER) AS hits, CAST(score AS INTEGER) AS score, CAST(row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) <= 3
""",
)
def retrieved_facts(spark: SparkSession, d: str) -> DataFrame:
    """The best facts of each kind for a question's stems."""
    terms = ["there", "wheth", "tions", "heren", "quere", "schen", "erver", "mento"]
    out = texts.retrieved(table(spark, d, "documents"), "text", "source", terms, {"src0": 2, "src1": 1}, 3, [F.col("doc_id")])
    return out.select("source", "doc_id", "hits", "score", "rank")


@query(
    "spotted_names",
    """SELECT p_partkey, 0 AS at, p_type AS name FROM part UNION ALL SELECT p_partkey, 1, p_name FROM part""",
)
def spotted_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in texts, longest first, each word used once."""
    named = table(spark, d, "part").select(F.concat_ws(" ", "p_type", "p_name").alias("body"), "p_partkey")
    names = table(spark, d, "part").select(F.explode(F.array("p_name", F.split("p_name", " ")[0], F.split("p_name", " ")[1], "p_type")).alias("name")).distinct()
    return texts.spotted(named, names, "p_partkey", "body", "name")


@query(
    "slugs",
    """SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, trim(regexp_replace(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9\\s-]', '', 'g'), '[\\s-]+', '-', 'g'), '-') AS bare, regexp_replace(lower(p_brand || p_name), '[^a-z0-9]', '', 'g') AS key FROM part""",
)
def slugs(spark: SparkSession, d: str) -> DataFrame:
    """The slug and fold functions."""
    name = F.concat_ws(" ", "p_brand", "p_name")
    return table(spark, d, "part").select("p_partkey", tx.slug(name).alias("slug"), tx.punctuation_free_slug(name).alias("bare"), tx.key(name).alias("key"))


@query(
    "text_excerpts",
    """SELECT doc_id, CASE WHEN length(text) <= 60 THEN text ELSE regexp_replace(substr(text, 1, 60), '\\s+\\S*$', '') || '…' END AS excerpt FROM documents""",
)
def text_excerpts(spark: SparkSession, d: str) -> DataFrame:
    """Excerpts cut before a word."""
    return table(spark, d, "documents").select("doc_id", tx.shorten(F.col("text"), 60).alias("excerpt"))


@query(
    "listings",
    f"""
WITH {DECKS}, x AS (SELECT DISTINCT format, archetype FROM decks), y AS (SELECT format, list(archetype ORDER BY archetype) AS a FROM x GROUP BY 1)
SELECT format, CASE WHEN len(a) <= 1 THEN a[1] ELSE array_to_string(a[1:len(a) - 1], ', ') || ' and ' || a[len(a)] END AS listing FROM y
""",
)
def listings(spark: SparkSession, d: str) -> DataFrame:
    """X30 U01 T12: 'a, b and c'."""
    x = decks(spark, d).groupBy("format").agg(F.array_sort(F.collect_set("archetype")).alias("a"))
    return x.select("format", tx.listing(F.col("a")).alias("listing"))


@query(
    "natural_order",
    """SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER), p_brand, p_partkey) AS rank FROM part""",
)
def natural_order(spark: SparkSession, d: str) -> DataFrame:
    """Collector numbers of each type in natural order."""
    w = Window.partitionBy("p_type").orderBy(tx.natural(F.col("p_brand")), "p_partkey")
    return table(spark, d, "part").select("p_partkey", "p_brand", F.row_number().over(w).cast("bigint").alias("rank"))


@query(
    "date_functions",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS number, CAST(greatest(1, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-07-01')) AS INTEGER) AS days,
 o_orderdate < TIMESTAMP '1998-07-01' - INTERVAL 30 DAY AS stale, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS month_before FROM orders
""",
)
def date_functions(spark: SparkSession, d: str) -> DataFrame:
    """Stamps, day numbers, days between, staleness and months."""
    ts = F.col("o_orderdate").cast("timestamp")
    now = F.lit("1998-07-01").cast("timestamp")
    return table(spark, d, "orders").select(
        "o_orderkey",
        dates.stamp(ts).alias("stamp"),
        dates.day_number(F.to_date(ts)).alias("number"),
        dates.days_between(F.to_date(ts).cast("string"), F.lit("1998-07-01")).alias("days"),
        dates.stale(ts, now, 30).alias("stale"),
        dates.months_back(ts, 2)[1].alias("month_before"),
    )


@query(
    "tint_luminance",
    """SELECT p_partkey, round(0.2126 * lr + 0.7152 * lg + 0.0722 * lb, 6) AS luminance FROM (SELECT p_partkey, CASE WHEN r <= 0.04045 THEN r / 12.92 ELSE pow((r + 0.055) / 1.055, 2.4) END AS lr, CASE WHEN g <= 0.04045 THEN g / 12.92 ELSE pow((g + 0.055) / 1.055, 2.4) END AS lg, CASE WHEN b <= 0.04045 THEN b / 12.92 ELSE pow((b + 0.055) / 1.055, 2.4) END AS lb FROM (SELECT p_partkey, (p_size * 5 % 256) / 255.0 AS r, (p_partkey % 256) / 255.0 AS g, (p_size * p_partkey % 256) / 255.0 AS b FROM part))""",
)
def tint_luminance(spark: SparkSession, d: str) -> DataFrame:
    """Relative luminance of colours."""
    r, g, b = F.col("p_size") * 5 % 256 / 255.0, F.col("p_partkey") % 256 / 255.0, F.col("p_size") * F.col("p_partkey") % 256 / 255.0
    return table(spark, d, "part").select("p_partkey", F.round(images.luminance(r, g, b), 6).alias("luminance"))


@query(
    "tints",
    """
WITH p AS (SELECT p_brand, p_size * 5 % 256 AS r, p_partkey % 256 AS g, p_size * p_partkey % 256 AS b FROM part), m AS (SELECT *, CAST(r AS DOUBLE) / 255 AS x, CAST(g AS DOUBLE) / 255 AS y, CAST(b AS DOUBLE) / 255 AS z, greatest(x, y, z) AS hi, least(x, y, z) AS lo FROM p),
h AS (SELECT *, hi - lo AS d, CASE WHEN hi = 0 THEN 0 ELSE (hi - lo) / hi END AS w FROM m),
u AS (SELECT *, CASE WHEN d = 0 THEN 0 WHEN hi = x THEN CASE WHEN y >= z THEN (y - z) / d ELSE (y - z) / d + 6 END WHEN hi = y THEN (z - x) / d + 2 ELSE (x - y) / d + 4 END AS hue FROM h),
q AS (SELECT p_brand, CAST(floor(hue * 24 / 6) AS INTEGER) AS bin, sum(w) AS mass, sum(r * w) / nullif(sum(w), 0) AS r, sum(g * w) / nullif(sum(w), 0) AS g, sum(b * w) / nullif(sum(w), 0) AS b FROM u GROUP BY 1, 2),
f AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY round(mass, 9) DESC, bin) = 1)
SELECT p_brand, lower('#' || lpad(to_hex(CAST(round(coalesce(r, 0)) AS BIGINT)), 2, '0') || lpad(to_hex(CAST(round(coalesce(g, 0)) AS BIGINT)), 2, '0') || lpad(to_hex(CAST(round(coalesce(b, 0)) AS BIGINT)), 2, '0')) AS tint FROM f
""",
)
def tints(spark: SparkSession, d: str) -> DataFrame:
    """The tint of each brand's pixels."""
    px = table(spark, d, "part").select("p_brand", (F.col("p_size") * 5 % 256).alias("r"), (F.col("p_partkey") % 256).alias("g"), (F.col("p_size") * F.col("p_partkey") % 256).alias("b"))
    return images.tint(px, "p_brand")


@query("image_sizes", """SELECT p_partkey, p_size AS width, p_size + 7 AS height FROM part""")
def image_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes from image headers."""
    big = lambda c: F.unhex(F.lpad(F.hex(c.cast("bigint")), 8, "0"))
    header = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), big(F.col("p_size")), big(F.col("p_size") + 7))
    return table(spark, d, "part").select("p_partkey", images.image_size(header).alias("x")).select("p_partkey", "x.width", "x.height")


@query(
    "significant_figures",
    """SELECT l_orderkey, l_linenumber, CAST(format('{:.4g}', l_extendedprice * 1.00013 / 7) AS DOUBLE) AS price FROM lineitem""",
)
def significant_figures(spark: SparkSession, d: str) -> DataFrame:
    """Four significant figures."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", numbers.significant(F.col("l_extendedprice") * 1.00013 / 7).alias("price"))


@query("document_bodies", f"""WITH {DECKS} SELECT CAST(deck_id AS VARCHAR) AS key, '{{"deck_id":' || deck_id || ',"archetype":"' || archetype || '"' || CASE WHEN place <= 2 THEN ',"place":' || place ELSE '' END || '}}' AS body FROM decks WHERE published""")
def document_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Compact documents without null fields, safe keys only."""
    rows = decks(spark, d).where("published").select("deck_id", "archetype", F.when(F.col("place") <= 2, F.col("place")).alias("place"))
    return sinks.documents(rows, "deck_id").select("key", "body")


@query("published_manifest", f"""WITH {DECKS} SELECT player AS key, 'new' AS status FROM decks WHERE regexp_matches(replace(player, '#', '-'), '^[A-Za-z0-9_-]+$') GROUP BY 1""".replace("SELECT player AS key", "SELECT replace(player, '#', '-') AS key"))
def published_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Documents first, then their manifest, the pointer last."""
    import uuid

    from gleaner.session import shared_folder

    rows = decks(spark, d).groupBy(F.replace("player", F.lit("#"), F.lit("-")).alias("player")).agg(F.count(F.lit(1)).alias("decks"))
    docs = sinks.documents(rows, "player")
    return sinks.publish(spark, docs, f"{shared_folder(spark)}/site/{uuid.uuid4().hex}").select("key", "status")


@query(
    "markdown_pages",
    f"""
WITH {DECKS}, x AS (SELECT DISTINCT format, archetype, kind FROM decks), s AS (SELECT format, kind, '## ' || kind || chr(10) || chr(10) || string_agg('- ' || archetype, chr(10) ORDER BY archetype) AS t, min(archetype) AS o FROM x GROUP BY 1, 2)
SELECT format, '---' || chr(10) || 'title: ' || format || chr(10) || '---' || chr(10) || chr(10) || string_agg(t, chr(10) || chr(10) ORDER BY o, kind) || chr(10) AS text FROM s GROUP BY 1
""",
)
def markdown_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents with front matter and sections in first-reached order."""
    x = decks(spark, d).select("format", F.col("format").alias("title"), "kind", "archetype", F.col("archetype").alias("line")).distinct()
    return sinks.markdown(x, "format", "title", "kind", "archetype", "line").select("format", "text")


@query(
    "category_walk",
    """
WITH RECURSIVE e AS (SELECT p_partkey AS a, (p_partkey * 7 + 3) % 2000 AS b FROM part UNION SELECT p_partkey, (p_partkey * 3 + 1) % 2000 FROM part WHERE p_size < 10),
r AS (SELECT 5 AS node, 0 AS steps UNION SELECT b, steps + 1 FROM r JOIN e ON e.a = r.node WHERE steps < 5) SELECT CAST(node AS BIGINT) AS node, CAST(min(steps) AS INTEGER) AS steps FROM r GROUP BY 1
""",
)
def category_walk(spark: SparkSession, d: str) -> DataFrame:
    """Everything within five steps of a root, circles and all."""
    part = table(spark, d, "part")
    e = part.select(F.col("p_partkey").alias("a"), ((F.col("p_partkey") * 7 + 3) % 2000).alias("b")).union(part.where("p_size < 10").select("p_partkey", (F.col("p_partkey") * 3 + 1) % 2000))
    return graph.reachable(e, spark.createDataFrame([(5,)], "node long"), "a", "b", 5)


def _events(spark: SparkSession, d: str) -> DataFrame:
    rows = streams.stream(spark, f"{d}/events.parque[t]", spark.read.parquet(f"{d}/events.parquet").schema)  # a glob may be a file
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "streamed_shares",
    """SELECT w AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest(generate_series(date_trunc('day', ts) - INTERVAL 6 DAY, date_trunc('day', ts), INTERVAL 1 DAY)) AS w FROM events) GROUP BY 1, 2""",
)
def streamed_shares(spark: SparkSession, d: str) -> DataFrame:
    """Sliding weekly windows of a stream equal the batch."""
    out = streams.settled(streams.shares(_events(spark, d), "ts", "event_type"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")


@query(
    "streamed_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events), x AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM x GROUP BY user_id, k""",
)
def streamed_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a stream."""
    out = streams.settled(streams.sessions(_events(spark, d), "ts", "user_id"))
    return out.select("user_id", F.col("session_window.start").alias("start"), "n")


@query("streamed_first_seen", """SELECT user_id, min(ts) AS first_seen FROM events GROUP BY 1""")
def streamed_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """When each key was first seen."""
    return streams.settled(streams.first_seen(_events(spark, d), "ts", "user_id"))


@query("streamed_state", """SELECT user_id, max(event_id) AS last_event, count(*) AS n FROM events GROUP BY 1""")
def streamed_state(spark: SparkSession, d: str) -> DataFrame:
    """A state table that every batch is merged into."""

    def merge(state: DataFrame, batch: DataFrame) -> DataFrame:
        new = batch.groupBy("user_id").agg(F.max("event_id").alias("last_event"), F.count(F.lit(1)).alias("n"))
        return state.union(new).groupBy("user_id").agg(F.max("last_event").alias("last_event"), F.sum("n").alias("n"))

    return streams.upserted(_events(spark, d), merge, "user_id long, last_event long, n long")


@query("streamed_matches", """SELECT a.event_id AS view_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR WHERE a.event_type = 'view' AND b.event_type = 'purchase'""")
def streamed_matches(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one stream matched with later rows of another."""
    a = _events(spark, d).where("event_type = 'view'").select("user_id", F.col("ts").alias("ta"), F.col("event_id").alias("view_id"))
    b = _events(spark, d).where("event_type = 'purchase'").select("user_id", F.col("ts").alias("tb"), F.col("event_id").alias("purchase_id"))
    return streams.settled(streams.matched(a, b, "user_id", "ta", "tb", "1 hour"), "append").select("view_id", "purchase_id")


@query(
    "streamed_debuts",
    """SELECT o_custkey AS customer, CAST(o_orderdate AS TIMESTAMP) AS first_seen FROM (SELECT DISTINCT o_custkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS before FROM orders) WHERE before IS NULL OR o_orderdate > before + INTERVAL 30 DAY""",
)
def streamed_debuts(spark: SparkSession, d: str) -> DataFrame:
    """Customers whose orders arrive year by year, each reported when seen after 30 days of silence; the state forgets those."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    span = orders.agg(F.year(F.min("ts")), F.year(F.max("ts"))).first()
    years = (orders.where(F.year("ts") == y) for y in range(span[0], span[1] + 1))
    return streams.reruns(years, lambda rows: rows, run=lambda rows, at: seen.debuts(rows, "ts", "customer", at))


@query(
    "streamed_waits",
    """SELECT a.event_id AS view_id, b.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'view') a LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR""",
)
def streamed_waits(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one stream with later rows of another, or alone once the wait is over. The last slice is a heartbeat of both
    streams that moves the watermark past all waits; it belongs to nobody."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    span = events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [span[0] + (span[1] - span[0]) * k / 3 for k in range(1, 3)]
    edges = [F.col("ts") < cuts[0], (F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1]), F.col("ts") >= cuts[1]]
    heartbeat = spark.createDataFrame([(-1, "view"), (-2, "purchase")], "user_id long, event_type string").select(F.lit(None).cast("long").alias("event_id"), "user_id", "event_type", F.lit(span[1] + timedelta(days=30)).alias("ts"))

    def waits(rows: DataFrame) -> DataFrame:
        a = rows.where("event_type = 'view'").select("user_id", F.col("ts").alias("ta"), F.col("event_id").alias("view_id"))
        b = rows.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("tb"), F.col("event_id").alias("purchase_id"))
        return streams.matched(a, b, "user_id", "ta", "tb", "1 hour", "left_outer")

    return streams.reruns([*(events.where(e) for e in edges), heartbeat], waits).where("view_id is not null").select("view_id", "purchase_id")
