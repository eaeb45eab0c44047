"""Pages whose fields drift, articles, caches with an age, and versions of a base and patches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.operators import state, versions
from gleaner.plans import registry
from gleaner.sources import html, pagejson

NOW = datetime(2024, 6, 30)


def page(spark, *bodies):
    return pagejson.parsed(spark.createDataFrame(list(enumerate(bodies)), "k int, b string"), "k", "b")


def card(fields, rest=""):
    return '{"container":{"json_dict":{"card":{%s}%s}}}' % (fields, rest)


def test_entries_check_each_type(spark):
    good = '{"container":{"json_dict":{"card":{"name":"A","num_decks":40,"potential_decks":90,"salt":1.256}}},"land":36,"basic":12.5,"bracket_counts":{"1":2,"3":"x","5":0,"6":9,"12":1}}'
    bodies = [good, card('"name":"B","num_decks":"40"'), card('"num_decks":0'), card('"name":7,"num_decks":5,"potential_decks":-1,"salt":"x"'), "[1]", "no json", None, "{}", card('"num_decks":3.5'), '{"container":[]}']
    got = {r["k"]: tuple(r)[1:] for r in pagejson.entries(page(spark, *bodies), "k").collect()}
    assert got == {0: ("A", 40, 90, 1.26, 36, None, {"1": 2, "5": 0}), 3: (None, 5, None, None, None, None, {})}
    assert [r["k"] for r in pagejson.usable(pagejson.entries(page(spark, *bodies), "k")).collect()] == [0]


def test_sections_and_ranks(spark):
    lists = ',"cardlists":[{"tag":"new","header":"New","cardviews":[{"name":"x","num_decks":3,"synergy":0.126},{"name":"","num_decks":3},{"num_decks":1},{"name":"y","num_decks":"3"},7,{"name":"z","num_decks":1,"potential_decks":0}]},{"cardviews":{"a":1}},5,{"cardviews":[{"name":"w","num_decks":2,"potential_decks":8}]}]'
    pages = page(spark, card('"num_decks":10', lists), card('"num_decks":10', ',"cardlists":{"a":[]}'), None)
    got = sorted((r["k"], r["list"], r["tag"], r["pos"], r["name"], r["decks"], r["of_decks"], r["synergy"]) for r in pagejson.sections(pages, "k").collect())
    assert got == [(0, 0, "new", 0, "x", 3, 10, 0.13), (0, 0, "new", 1, "z", 1, 10, None), (0, 3, "", 0, "w", 2, 8, None)]
    own = '{"cardviews":[{"name":"a","sanitized":"a","num_decks":1,"rank":9},{"name":"b","num_decks":1},{"name":"c","sanitized":"c","num_decks":2,"trend_zscore":0.25}]}'
    first = '{"cardviews":3,"container":{"json_dict":{"cardlists":[{"cardviews":[{"name":"d","sanitized":"d","num_decks":4,"rank":"1"}]},{"cardviews":[{"name":"e","sanitized":"e","num_decks":4}]}]}}}'
    got = sorted((r["k"], r["rank"], r["slug"], r["decks"], r["trend"]) for r in pagejson.ranked(page(spark, own, first, "{}"), "k").collect())
    assert got == [(0, 2, "c", 2, 0.3), (0, 9, "a", 1, None), (1, 1, "d", 4, None)]


def test_themes_keep_their_order(spark):
    body = '{"tag_counts":[{"slug":"a","value":"A","count":3},{"slug":"b","value":"B","count":40},{"slug":"c","value":"C","count":40},{"slug":"","value":"D","count":90},{"slug":"e","value":"E","count":"9"},null,"x"]}'
    found = pagejson.themes(page(spark, body, '{"tag_counts":{}}', None), "k")
    assert sorted((r["pos"], r["slug"], r["decks"]) for r in found.collect()) == [(1, "b", 40), (2, "c", 40), (3, "a", 3)]
    assert {r["slug"] for r in pagejson.shown_themes(found, 30, 1).collect()} == {"b"}


def test_articles(spark):
    long = "word " * 6000
    bodies = {
        "two articles": "<article><p>short</p></article><nav><p>menu</p></nav><article><h1>Title</h1><p>Some <b>bold</b>text<br>next</p><ul><li>item</li></ul><aside><p>aside</p></aside><script>var x</script><footer><p>foot</p></footer></article><p>outside</p>",
        "main": "<header><h1>Site</h1></header><main><p>a  b\n c</p><div><p></p><h5>no line</h5></div></main><p>out</p>",
        "bare": "<div>only <i>text</i> here</div>",
        "nested": "<article><p>outer</p><article><p>inner one</p></article></article>",
        "long": f"<article><p>{long}</p></article>",
        "empty": "",
        "null": None,
        "quiet": "<nav><article><p>in the menu</p></article></nav><p>kept</p>",
    }
    got = {r["k"]: r["text"] for r in html.articles(spark.createDataFrame(list(bodies.items()), "k string, h string"), "k", "h").collect()}
    assert got["two articles"] == "Title\nSome bold text next\nitem\naside"
    assert got["main"] == "a b c" and got["bare"] == "only text here" and got["nested"] == "outer\ninner one"
    assert len(got["long"]) == 20_000 and got["empty"] == got["null"] == "" and got["quiet"] == "kept"


def test_article_query_has_a_text_for_every_page(spark, sf_dir):
    rows = registry.queries()["article_texts"](spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert {r["page_id"] for r in rows} == set(pages)
    assert all(len(r["text"]) <= 20_000 and "<" not in r["text"] and "track(" not in r["text"] for r in rows)


def test_cache_tiers(spark):
    """Page, fresh, fresh none, budget, failed fetch with and without an old value, beyond the budget, a fetched none."""
    days = lambda n: NOW - timedelta(days=n)
    asked = [("page", 1), ("fresh", 2), ("fresh none", 3), ("old", 4), ("failed", 5), ("failed new", 6), ("gone", 7), ("beyond", 8), ("beyond new", 9), ("old none", 4)]
    cache = [("page", 1, days(1)), ("fresh", 2, days(7)), ("fresh none", None, days(3)), ("old", 4, days(8)), ("failed", 5, days(30)), ("gone", 7, days(9)), ("beyond", 8, days(99)), ("old none", None, days(50)), ("unasked", 1, days(1))]
    fetched = [("old", 40, True), ("failed", None, False), ("gone", None, True), ("beyond", 80, True), ("fresh", 20, True), ("old none", 44, True)]
    frame = spark.createDataFrame
    out = state.answered(frame(asked, "k string, pos int"), frame([("page", 10)], "k string, value int"), frame(cache, "k string, value int, checked_at timestamp"), frame(fetched, "k string, value int, ok boolean"), "k", F.lit(NOW), 7, 5)
    got = {r["k"]: (r["tier"], r["value"], r["kept"], r["checked_at"]) for r in out.collect()}
    assert got == {
        "page": ("page", 10, 10, NOW), "fresh": ("cache", 2, 2, days(7)), "fresh none": ("cache", None, None, days(3)), "old": ("fetched", 40, 40, NOW), "old none": ("fetched", 44, 44, NOW), "failed": ("stale", 5, 5, days(30)),
        "failed new": ("none", None, None, None), "gone": ("fetched", None, None, NOW), "beyond": ("stale", 8, 8, days(99)), "beyond new": ("none", None, None, None),
    }


def test_versions(spark):
    """Patches, a run without a change, a failed result, and a rebase that reads the same but for what has left."""
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    current = lambda **x: frame(list(x.items()), "id string, uri string")
    done = lambda **x: frame(list(x.items()), "id string, value int")
    read = lambda v: {r["id"]: (r["uri"], r["value"]) for r in versions.reading(v).collect()}
    v = versions.advanced(None, current(a="1", b="1", c="1"), done(a=1, b=2, c=3), most=2)
    assert (v.master, v.latest, read(v)) == (1, 0, {"a": ("1", 1), "b": ("1", 2), "c": ("1", 3)})
    assert versions.advanced(v, current(a="1", b="1"), done(), most=2) is v
    v = versions.advanced(v, current(a="2", b="1"), done(a=10), most=2)
    v = versions.advanced(v, current(a="3", b="2"), done(a=11), most=2, failed=0.5)
    assert (v.master, v.latest, read(v)) == (1, 2, {"a": ("3", 11), "b": ("1", 2), "c": ("1", 3)})
    assert {r["id"] for r in versions.pending(v, current(a="3", b="2")).collect()} == {"b"}
    with pytest.raises(ValueError, match="1 of 1"):
        versions.advanced(v, current(a="3", b="2"), done())
    before = read(v)
    v = versions.advanced(v, current(a="3", b="2", d="1"), done(b=20, d=4), most=2)
    assert (v.master, v.latest) == (2, 0) and v.rows.where("patch > 0").count() == 0
    assert read(v) == {k: x for k, x in before.items() if k != "c"} | {"b": ("2", 20), "d": ("1", 4)}
