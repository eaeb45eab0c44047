"""Work that must not grow faster than its input: what meets is counted, not timed."""

import re
import uuid
from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from gleaner import session
from gleaner.operators import containment, filling, matching, similarity, texts, winning
from gleaner.plans import bindings, registry
from gleaner.plans import filling as bound
from gleaner.plans import merging as merges
from gleaner.plans import winning as plans
from gleaner.sources import history, html

mapped = DataFrame.mapInPandas


def test_nearest_joins_one_row_a_day(spark, monkeypatch):
    """40 rows look at 40 others on each of three days: the chosen ones alone meet them."""
    day = lambda k: date(2024, 1, 1) + timedelta(days=k)
    a = spark.createDataFrame([(i, 1, day(1)) for i in range(40)], "a int, g int, day date")
    b = spark.createDataFrame([(100 * k + i, 1, day(k)) for k in (0, 2, 5) for i in range(40)], "b int, g int, other date")
    met, first = [], matching.first_per_key
    monkeypatch.setattr(matching, "first_per_key", lambda df, *of: met.append(df.count()) or first(df, *of))
    out = matching.nearest(a, b, ["g"], "a", "day", "other", 1, 1, [-F.col("b")]).select("a", "b", "gap")
    assert sorted(out.collect()) == [(i, 239, 1) for i in range(40)]
    assert met[-1] == 80


def test_history_frames_hold_many_cards(spark, monkeypatch):
    """A file of 300 cards is read in few frames, and its bytes are those of the plain encoder."""
    ids = [str(uuid.UUID(int=i)) for i in range(300)]
    pts = [(p, f, 100 + 3 * d, 70 * d + f) for p in ids for f in (0, 2) for d in range(4)]
    series = {p: {f: [(day, cents) for q, g, day, cents in pts if (q, g) == (p, f)] for f in (0, 2)} for p in ids[:3]}
    each = lambda k, few: np.array([x[k] for x in pts if x[0] in few], object if k == 0 else np.int64)
    assert history.encode_points(*(each(k, ids[:3]) for k in range(4)), 100, 200) == history.encode_history(series, 100, 200)
    data, run = history.encode_points(*(each(k, ids) for k in range(4)), 100, 200), []
    contents = spark.createDataFrame([(bytearray(data),)], "content binary")
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda df, f, schema: run.append(f) or mapped(df, f, schema))
    assert history.points(contents).count() == len(pts)
    frames = list(run[0](iter([pd.DataFrame({"content": [data]})])))
    assert len(frames) == 1 and list(frames[0].itertuples(index=False, name=None)) == pts


def test_lines_are_dealt_by_deck_in_more_parts_the_more_there_are(spark, sf_dir):
    """Aggregates by deck need no other shuffle, and a large table gets more tasks, not larger ones."""
    plan = bindings.lines(spark, sf_dir).groupBy("deck_id", "slug").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(l_orderkey") == 1
    few, many = (session.spread(spark.range(10), n, "id").rdd.getNumPartitions() for n in (1_000_000, 50_000_000))
    assert few <= 4 and many == 100


def test_profiles_come_to_the_items(spark):
    """Items dealt by item are not dealt again where the profiles' weights are few; where they are many the cosines are the same."""
    items = spark.createDataFrame([(i, k, float(1 + (i * k) % 5)) for i in range(60) for k in range(i % 7)] + [(None, 1, 1.0)], "i int, k int, w double").repartition("i")
    profiles = spark.createDataFrame([(p, k, float(1 + (p + k) % 3)) for p in range(4) for k in range(p, 6)], "p int, k int, w double")
    few, many = (similarity.profile_cosine(items, profiles, "i", "p", ["k"], most=n) for n in (1_000_000, 0))
    assert few._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    plain = similarity.sparse_cosine(items, profiles, "i", "p", ["k"])
    of = lambda df: sorted((r["i"], r["p"], round(r["cosine"], 12)) for r in df.collect())
    assert of(few) == of(many) == of(plain) and len(of(few)) == 150


def test_requests_of_styles_dealt_by_style_shuffle_nothing(spark):
    """A style's cards and commanders meet where they lie; the first of a card's rows gives the same request as all of them."""
    have = spark.createDataFrame([(s, n, f"c{(s * k) % 7}", k) for s in range(20) for k in range(9) for n in (1 + k % 3, 5)], "style int, level int, card string, pos int").repartition("style")
    first = have.groupBy("style", "card").agg(F.min(F.struct("level", "pos")).alias("x")).select("style", "x.level", "card", "x.pos")
    who = spark.createDataFrame([(s, f"c{c}") for s in range(21) for c in (0, 3)], "style int, card string").repartition("style")
    out = winning.request(have, who)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert sorted(out.collect()) == sorted(winning.request(first, who).collect()) and out.where("size(main) > 0").count() == 17


def test_lines_are_read_once_for_filled_decks(spark, sf_dir, monkeypatch):
    """What a deck is filled from lies in small tables, and levels of the same cards look for combinations once."""
    candidates, listed, who, combos = bound.inputs(spark, sf_dir)
    assert not any("lineitem" in f or "orders" in f for df in (candidates, listed, who) for f in df.inputFiles())
    met, contained = [], filling.contained
    monkeypatch.setattr(filling, "contained", lambda sets, held, *of: met.append(held.select("deck").distinct().count()) or contained(sets, held, *of))
    filling.fill(candidates, listed, who, combos)
    assert met == [listed.count() // 5] == [25]


def test_lists_are_made_once_for_assigned_results(spark, sf_dir, monkeypatch):
    """The plan, its profiles and the results come from one table of lists, and a list stays where it lies to meet the leaders."""
    made, of = [], merges.lines
    monkeypatch.setattr(merges, "lines", lambda *a: made.append(a) or of(*a))
    for run in (merges.merge_assigned, merges.merge_report):
        assert not any("lineitem" in f for f in run(spark, sf_dir).inputFiles())
    assert len(made) == 2


def test_names_come_to_texts_dealt_by_key(spark):
    """Texts are dealt once, before their phrases are made; many names meet the phrases by a shuffle and give the same."""
    rows = spark.createDataFrame([(i, f"a red dragon {i % 7} sleeps near the red dragon {i % 7} red") for i in range(70)], "k int, t string")
    names = spark.createDataFrame([(n,) for n in ["Red", "Red Dragon", "dragon 3", "near the", "sleeps near"]], "name string")
    few, many = (texts.spotted(rows, names, "k", "t", "name", most=n) for n in (1_000_000, 0))
    assert few._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() == 70 * 4


def test_elements_of_a_large_page_go_out_in_pieces(spark, monkeypatch):
    """A page of 20,000 rows gives frames of some thousand elements, whole and each once; what is still open waits."""
    run, page = [], "<div>" + "".join(f"<p>row {i} &amp; a < b</p>" for i in range(20_000)) + "</div>"
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda df, f, schema: run.append(f) or mapped(df, f, schema))
    html.elements(spark.createDataFrame([(1, "")], "k int, h string"), "k", "h", ["p"], ["div"])
    frames = list(run[0](iter([pd.DataFrame({"k": [1], "h": [page]})])))
    assert max(map(len, frames)) < 12_000 and sum(map(len, frames)) == 20_001
    assert sorted(x for f in frames for x in f["pos"]) == list(range(1, 20_002))
    assert list(pd.concat(frames).query("tag == 'p'").sort_values("pos")["text"]) == [f"row {i} & a < b" for i in range(20_000)]


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()))


def test_brackets_look_once_at_the_cards_of_a_style(spark, sf_dir, monkeypatch):
    """Not once a level: a style is one row where combinations meet it, and no card of a level is a row of a shuffle."""
    met, holding = [], filling.holding
    monkeypatch.setattr(filling, "holding", lambda decks, *of: met.append((decks.count(), decks.select("style").distinct().count())) or holding(decks, *of))
    out = registry.queries()["deck_brackets"](spark, sf_dir)
    assert met[0][0] == met[0][1] > 100 and "style" in exchanges(out) and not any("level" in e and "card" in e for e in exchanges(out))


def test_sets_meet_collections_where_they_lie(spark):
    """Few sets or many, in one block or in several: the pairs are those of contained, and collections are not shuffled."""
    held = spark.createDataFrame([(k, [(k * i) % 11 for i in range(k % 9)]) for k in range(60)], "k int, items array<int>").repartition("k")
    sets = spark.createDataFrame([(s, [s % 5, s % 7, s % 3][: s % 4]) for s in range(40)] + [(99, None)], "s int, of array<int>")
    of = lambda df: sorted((r["k"], r["s"]) for r in df.collect())
    one, blocks = (containment.holding(held, "items", sets, "s", "of", most=n) for n in (1_000, 10))
    plain = containment.contained(sets.select("s", F.explode("of").alias("x")), held.select("k", F.explode("items").alias("x")), "s", "k", "x")
    assert exchanges(one) == ["k"] and of(one) == of(blocks) == of(plain) and len(of(one)) > 200


def test_win_lines_of_styles_dealt_by_style_shuffle_no_card(spark):
    """Cards of a style, its combinations and lines stay where the style lies; a card is no row for each level that has it."""
    have = spark.createDataFrame([(s, f"c{(s * k) % 11}", 1 + k % 5, k == 0) for s in range(1, 20) for k in range(9)], "style int, card string, from int, lead boolean").dropDuplicates(["style", "card"]).repartition("style")
    combos = spark.createDataFrame([(f"x{i}", [f"c{i}", f"c{(i + 2) % 11}"], ["Win the game"] if i % 2 else ["Infinite mana"], "P", i) for i in range(11)], "combo string, cards array<string>, results array<string>, tag string, rank long")
    cards = spark.createDataFrame([(f"c{i}", float(i % 4), {"mana": "Infinite damage"} if i % 3 else {}) for i in range(11)], "card string, mana_value double, kinds map<string,string>")
    out = winning.style_lines(winning.nested_lines(combos, have, cards, 5))
    assert sorted(e for e in exchanges(out) if "style" in e) == ["style", "style, card"] and out.count() > 50


def test_win_lines_look_once_at_the_cards_of_a_style(spark, sf_dir, monkeypatch):
    met, holding = [], winning.holding
    monkeypatch.setattr(winning, "holding", lambda decks, *of: met.append((decks.count(), decks.select("style").distinct().count())) or holding(decks, *of))
    out = registry.queries()["win_lines"](spark, sf_dir)
    assert met[0][0] == met[0][1] > 100 and not any("level" in e and "card" in e for e in exchanges(out))


def test_facts_of_guides_read_each_card_of_a_style_once(spark, sf_dir, duck):
    """No card of a level is a row of a shuffle; notes, key cards and levels are those of the decks."""
    out = registry.queries()["guide_facts"](spark, sf_dir)
    assert "style" in exchanges(out) and not any("level" in e and "card" in e for e in exchanges(out))
    want = duck.sql(f"WITH {plans._BASE} SELECT style, list(DISTINCT level ORDER BY level), list(DISTINCT card ORDER BY card), list(DISTINCT card ORDER BY card) FILTER (level <= 2) FROM have GROUP BY 1").fetchall()
    facts = {r["guide"]: r["facts"].split("\n") for r in out.collect()}
    assert len(want) == len(facts) > 100
    for style, levels, cards, early in want:
        notes = [x[2:].split(": ")[0] for x in facts[style] if x.startswith("- ")]
        assert sorted(notes) == sorted(f"{c} ({'utility' if c in (early or []) else 'payoff'})" for c in cards)
        assert f"Brackets: {', '.join(map(str, levels))}." in facts[style] and f"Key cards: {', '.join(cards[:8])}" in facts[style]
