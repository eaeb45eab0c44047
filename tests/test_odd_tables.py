"""Queries against their SQL on made tables: repeats, more rows of a group than the given tables have, and rare characters."""

import duckdb
import pytest
from pyspark.sql import functions as F

from gleaner.operators import containment, entities, pages, winning
from gleaner.plans import registry


@pytest.fixture
def equals_sql(spark, same, tmp_path):
    def check(name, **tables):
        con = duckdb.connect()
        con.sql("set timezone='UTC'")
        for t, select in tables.items():
            con.sql(f"copy ({select}) to '{tmp_path}/{t}.parquet' (format parquet)")
            con.sql(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet')")
        df, want = registry.queries()[name](spark, str(tmp_path)), con.sql(registry.oracle_sql()[name])
        rows = df.collect()
        assert same(df.columns, rows) == same(want.columns, want.fetchall())
        return rows

    return check


def parts(n, name="'part ' || k % 7", brand="'Brand#1'", size="CAST(k % 50 + 1 AS INTEGER)", kind="'PROMO'"):
    return f"SELECT CAST(k AS BIGINT) AS p_partkey, {name} AS p_name, {brand} AS p_brand, {kind} AS p_type, {size} AS p_size, 900.0 + k / 10 AS p_retailprice FROM range({n}) r(k)"


def test_pages_of_one_address_keep_their_own_change(equals_sql):
    pages = "SELECT CAST(k AS BIGINT) AS page_id, CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' https://a.example/?x=1&y=' || k % 3 || ' ' END AS url, '' AS html FROM range(40) r(k)"
    assert len(equals_sql("sitemap_entries", pages=pages)) == 40


def test_rule_book_with_sections_of_four_digits(equals_sql):
    rows = equals_sql("rule_book", part=parts(1500))
    assert any(r["kind"] == "section" and len(r["number"]) == 4 for r in rows)


@pytest.mark.parametrize("name", ["checked_events", "located_quotes", "evidence_reasons"])
def test_quotes_in_capitals_of_letters_without_one(equals_sql, name):
    documents = "SELECT CAST(k AS BIGINT) AS doc_id, 'straße weiß ich ' || k || chr(10) || 'größe schoß heiß ' || k || chr(10) || 'fuß paß maß' AS text, 'de' AS lang FROM range(20) r(k)"
    equals_sql(name, documents=documents)


def test_entities_of_one_name_are_weighed_once(spark):
    ids = spark.range(20_000)
    cards = ids.select(F.col("id").alias("card"), F.lit("Basic Land").alias("type_line"), F.array(F.lit("Rix")).alias("names"))
    known = ids.select("id", F.lit("Rix").alias("name"), F.when(F.col("id") % 2 == 0, "location").otherwise("artifact").alias("type"), F.when(F.col("id") == 8, 90).otherwise(10).alias("pages"))
    got = entities.matched(cards, known, known.select(F.lit("rix").alias("folded"), "id"))
    assert got.agg(F.count("*"), F.min("id"), F.max("id"), F.max("position")).first() == (20_000, 8, 8, 0)


def test_copies_of_combinations_are_listed_not_paired(equals_sql):
    rows = equals_sql("combo_supersets", part=parts(4_000, name="CASE WHEN k % 9 <> 5 THEN 'part ' || k % 4 * (k // 4 % 3) END", size="CAST(k // 8 % 5 * (k % 2) AS INTEGER)"))
    assert sum(r["same"] for r in rows) > 500 and 0 < sum(not r["same"] for r in rows) < 50


def test_containment_in_blocks_of_sets(spark):
    sets = spark.createDataFrame([(i, f"e{x}") for i in range(30) for x in (i % 5, i % 7, i)], "s int, e string").distinct()
    held = spark.createDataFrame([(k, f"e{x}") for k in range(12) for x in range(k + 1)], "c int, e string")
    of, has = {}, {}
    for s, e in sets.collect():
        of.setdefault(s, set()).add(e)
    for c, e in held.collect():
        has.setdefault(c, set()).add(e)
    for missing in (0, 1):
        want = sorted((s, c, len(a - b)) for s, a in of.items() for c, b in has.items() if len(a) > missing and len(a - b) <= missing)
        for most in (1_000, 20):
            got = containment.contained(sets, held, "s", "c", "e", missing, most)
            assert sorted((r["s"], r["c"], r["lacking"]) for r in got.collect()) == want


def test_combinations_of_a_style_lie_in_the_levels_of_all_their_cards(spark):
    elements = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a"), ("r", "b"), ("r", "c")], "combo string, card string")
    have = spark.createDataFrame([(1, 1, "a"), (1, 3, "a"), (1, 2, "b"), (1, 3, "b"), (1, 2, "c"), (2, 5, "a"), (2, 4, "b")], "style int, level int, card string")
    got = {(r["deck"]["style"], r["deck"]["level"], r["combo"]) for r in winning.held_by_decks(elements, have).collect()}
    assert got == {(1, 3, "p"), (1, 1, "q"), (1, 3, "q"), (1, 2, "r"), (2, 5, "q")}


def test_pages_of_few_blocks_are_read_by_many_tasks_and_once(spark, equals_sql, tmp_path):
    rows = equals_sql("wiki_paragraphs", part=parts(200))
    plan = registry.queries()["wiki_paragraphs"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 800 and plan.count("MapInPandas") == 1 and "REPARTITION_BY_NUM" in plan


def test_only_boxes_hide_what_is_in_them(spark):
    text = "<p>A paragraph that is long enough, {}</p>"
    body = '<div class="x"><span class="toc">' + text.format("in a span") + '</span><div class="navbox y">' + text.format("in a box") + "</div></div>"
    got = pages.wiki(spark.createDataFrame([(1, body)], "k int, h string"), "k", "h").collect()
    assert [r["text"] for r in got] == ["A paragraph that is long enough, in a span"]
