"""Operators against plain Python on small worlds: boundaries, ties, nulls and empty inputs."""

import datetime as dt
import uuid

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gleaner.functions import classify, dates, numbers, text
from gleaner.operators import containment, diff, graph, matching, priority, probability, similarity, tallies, texts, timeseries, topk, trends, windows
from gleaner.sources import history, html, jsonlines, sinks

settings.register_profile("spark", max_examples=15, deadline=None)
settings.load_profile("spark")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_window_edges(spark):
    df = spark.createDataFrame([("1998-06-24 00:00:00",), ("1998-06-23 23:59:59",), ("1998-07-01 23:00:00",), ("1998-07-02 00:00:00",), (None,)], "t string").select(F.to_timestamp("t").alias("ts"))
    got = windows.trailing(df, "ts", "1998-07-01 00:00:00", (7,)).select(F.date_format("ts", "MM-dd HH").alias("x"), "window")
    assert rows(got) == [("06-24 00", 7), ("07-01 23", 7)]
    old = df.where(windows.within(F.col("ts"), "1998-07-01 00:00:00", 30, until=7))
    assert old.count() == 1


def test_tally_adds_boards_and_floor(spark):
    lines = spark.createDataFrame([(1, "main", "a", 3), (1, "side", "a", 1), (2, "main", "a", 2), (2, "main", "b", 4)], "deck_id int, board string, slug string, qty long").withColumn("g", F.lit(1))
    assert rows(tallies.tally(lines, ["g"]).select("slug", "decks", "copies", "share", "avg_copies")) == [("a", 2, 6, 100.0, 3.0), ("b", 1, 4, 50.0, 4.0)]
    assert rows(tallies.consensus(lines, ["g"]).select("board", "slug", "quantity")) == [("main", "a", 3), ("main", "b", 4), ("side", "a", 1)]
    assert tallies.tally(lines.limit(0), ["g"]).count() == 0


@given(st.lists(st.integers(0, 50), min_size=1, max_size=12))
def test_apportioned_sums_to_whole(spark, amounts):
    df = spark.createDataFrame([(1, i, a) for i, a in enumerate(amounts)], "g int, i int, a int")
    got = tallies.apportioned(df, ["g"], "a", "i").collect()
    assert sum(r["units"] for r in got) == (1000 if sum(amounts) else 0)
    assert all(abs(r["units"] - 1000 * r["a"] / sum(amounts)) < 1 for r in got)


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 99)), max_size=12))
def test_forward_fill_equals_loop(spark, points):
    points = dict(points)
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, base + dt.timedelta(d), v) for d, v in points.items()], "k int, day date, v int")
    got = {(r["day"] - base).days: r["v"] for r in timeseries.filled(df, ["k"], "day", "v", "2024-01-06", "2024-01-15", 3).collect()}
    want = {d: next((points[x] for x in range(d, d - 4, -1) if x in points), None) for d in range(5, 15)}
    assert got == (want if any(v is not None for v in want.values()) else {})


def test_trend_thresholds(spark):
    df = spark.createDataFrame([(60, 100, 30, 100), (35, 100, 30, 100), (0, 0, 3, 10), (10, 10, 10, 10)], "a int, n int, b int, m int")
    got = [r[0] for r in df.select(trends.proportion_trend(*map(F.col, "anbm"))).collect()]
    assert got == ["up", "steady", None, "steady"]


def test_places_and_classifiers(spark):
    df = spark.createDataFrame([("1st",), ("Top 8",), ("Top 4",), ("5-0",), (None,)], "f string")
    assert [r[0] for r in df.select(classify.place(F.col("f"))).collect()] == [1, 5, 3, None, None]
    n = spark.createDataFrame([(1,), (2,), (3,), (4,), (9,), (11,), (112,)], "n int")
    assert [r[0] for r in n.select(classify.ordinal(F.col("n"))).collect()] == ["1st", "2nd", "3rd", "4th", "9th", "11th", "112th"]


def test_folding_and_rounding(spark):
    df = spark.createDataFrame([("Jötun Grunt // Back",), (None,), ("",)], "n string")
    assert [r[0] for r in df.select(text.slug(F.col("n"))).collect()] == ["jotun-grunt", None, ""]
    x = spark.createDataFrame([(2.25,), (0.35,), (2.675,), (None,)], "v double")
    assert [r[0] for r in x.select(numbers.half_even(1)(F.col("v"))).collect()][:2] == [2.2, 0.3]
    assert [r[0] for r in x.select(numbers.half_even(2)(F.col("v"))).collect()][2] == 2.67


def test_priority_merge_and_mode(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "w", 0)], "k int, v string, o int")
    b = spark.createDataFrame([(1, "y", 0), (2, "z", 0)], "k int, v string, o int")
    assert rows(priority.merged([a, b], ["k"], ["o"]).select("k", "v", "source")) == [(1, "w", 0), (2, "z", 1)]
    m = spark.createDataFrame([(1, "a", 5), (1, "b", 1), (1, "a", 6), (1, "b", 2)], "k int, v string, o int")
    assert rows(priority.mode_first_seen(m, ["k"], "v", "o")) == [(1, "b", 2)]


def test_queue_budget_spread(spark):
    df = spark.createDataFrame([(i, 3) for i in range(10)], "i int, c int").withColumn("g", F.lit(0))
    assert [r["i"] for r in topk.affordable(df, ["g"], [F.col("i")], "c", 10).orderBy("i").collect()] == [0, 1, 2]
    assert [r["i"] for r in topk.spread(df, ["g"], [F.col("i")], 4).orderBy("i").collect()] == [0, 3, 6, 9]
    assert [r["i"] for r in topk.spread(df, ["g"], [F.col("i")], 1).orderBy("i").collect()] == [9]


def test_containment_equals_brute_force(spark):
    sets = {1: {1, 2}, 2: {2, 3, 4}, 3: {9, 8}}
    decks = {10: {1, 2, 3}, 11: {2, 3, 4, 8}, 12: set()}
    s = spark.createDataFrame([(k, x) for k, v in sets.items() for x in v], "s int, x int")
    c = spark.createDataFrame([(k, x) for k, v in decks.items() for x in v], "c int, x int")
    got = rows(containment.contained(s, c, "s", "c", "x", missing=1).select("s", "c", "lacking"))
    want = sorted(((k, d, len(v - e)) for k, v in sets.items() for d, e in decks.items() if len(v - e) <= 1), key=str)
    assert got == want


def test_leaders_do_not_chain(spark):
    sizes = spark.createDataFrame([("f", "a", 9), ("f", "b", 5), ("f", "c", 1), ("g", "z", 1)], "g string, i string, n int")
    scores = spark.createDataFrame([("f", "a", "b", 0.9), ("f", "b", "c", 0.95)], "g string, a string, b string, cosine double")
    assert rows(similarity.leaders(sizes, scores, "g", "i", "n", 0.8)) == [("f", "a", "a"), ("f", "b", "a"), ("f", "c", "c"), ("g", "z", "z")]


def test_unions_respect_apart(spark):
    e = spark.createDataFrame([("g", 1, "a", "b"), ("g", 2, "b", "c"), ("g", 3, "c", "d")], "g string, ord int, a string, b string")
    apart = spark.createDataFrame([("g", "a", "c")], "g string, a string, b string")
    got = {n: r for _, n, r in rows(graph.union_with_apart(e, apart, "g"))}
    assert got["a"] == got["b"] != got["c"] == got["d"]


def test_components_and_roots(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (8, 7)], "a int, b int")
    assert rows(graph.min_label(spark, e, "a", "b")) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)]
    p = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 5), (5, 4)], "n int, p int")
    assert rows(graph.roots(spark, p, "n", "p")) == [(1, 1), (2, 1), (3, 1), (4, None), (5, None)]


def test_chance_is_exact_at_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.5), ("b", 0.5), ("b", 0.5)], "k string, p double")
    assert rows(probability.at_least_once(df, ["k"], "p")) == [("a", 1.0), ("b", 0.75)]


def test_projection_keeps_variance(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6)) * [1, 2, 3, 4, 5, 6]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, v array<double>")
    got = np.array([r["projected"] for r in similarity.projected(df, "v", 6, 2).orderBy("i").collect()])
    want = np.linalg.eigvalsh(np.cov(x.T, bias=True))[-2:]
    assert np.allclose(got.var(axis=0), want)


def test_greedy_pairs_are_one_to_one(spark):
    s = spark.createDataFrame([(0, 1, 1, 0.9), (0, 1, 2, 0.8), (0, 2, 1, 0.8), (0, 2, 2, 0.1)], "g int, a int, b int, s double")
    assert rows(matching.greedy_pairs(s, "g", "a", "b", "s").select("a", "b")) == [(1, 1), (2, 2)]


def test_deck_lines_boards_and_problems(spark):
    df = spark.createDataFrame([(1, "4 A b\r\n\r\n2 C"), (2, "\n3 X\nSideboard\n1 X\n<html>"), (3, None), (4, "")], "k int, t string")
    got = rows(texts.deck_lines(df, "k", "t").select("k", "board", "name", "quantity", "problem"))
    assert got == sorted([(1, "main", "A b", 4, None), (1, "side", "C", 2, None), (2, "main", "X", 3, None), (2, "side", "X", 1, None), (2, "side", None, None, "unknown line")], key=str)


def test_spotted_longest_first(spark):
    t = spark.createDataFrame([(1, "The Red Dragon met Red, then dragon."), (2, ""), (3, None)], "k int, t string")
    n = spark.createDataFrame([("Red Dragon",), ("Red",), ("Dragon",)], "name string")
    assert rows(texts.spotted(t, n, "k", "t", "name")) == [(1, 1, "Red Dragon"), (1, 4, "Red"), (1, 6, "Dragon")]


def test_html_survives_scripts_and_malformed_pages(spark):
    df = spark.createDataFrame([(1, "<script>'</p>'</script><h1>T</h1><p>one &amp; two<hr><h2>S</h2><p>three <b>x</b></p>"), (2, None), (3, "<p>open <a href=x>link</a>")], "k int, h string")
    got = rows(html.paragraphs(df, "k", "h").select("k", "kind", "text", "section", "scene"))
    assert (1, "p", "three x", "S", 1) in got and (1, "h1", "T", None, 0) in got and (3, "p", "open link", None, 0) in got


@given(st.dictionaries(st.integers(0, 5), st.dictionaries(st.integers(0, 2), st.dictionaries(st.integers(100, 200), st.integers(0, 10**6), min_size=1), min_size=1)))
def test_history_round_trip(world):
    series = {str(uuid.UUID(int=k)): {f: sorted(p.items()) for f, p in v.items()} for k, v in world.items()}
    data = history.encode_history(series, 100, 200)
    got = {}
    for printing, f, days, cents in history.decode_history(data):
        got.setdefault(printing, {})[f] = list(zip(days.tolist(), cents.tolist()))
    assert got == series
    with pytest.raises(ValueError):
        list(history.decode_history(b"XXXX" + data[4:]))


def test_history_files_in_spark(spark, tmp_path):
    ids = [str(uuid.UUID(int=i)) for i in range(4)]
    pts = spark.createDataFrame([(p, f, 100 + d, 5 * d + f) for p in ids for f in (0, 1) for d in range(5)], "printing string, finish int, day int, cents long")
    for r in history.files(pts, 100, 110, 2).collect():
        (tmp_path / f"{r['part']}.bin").write_bytes(bytes(r["content"]))
    got = history.read(spark, str(tmp_path), wanted=ids[:2], finish=0, since=102)
    assert got.count() == 6 and {r["printing"] for r in got.collect()} == set(ids[:2])


def test_json_sources(spark, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "a.json").write_text('[\n{"k": 1, "v": "x"},\n{"k": 2, "v": "y"}\n]\n')
    schema = StructType.fromDDL("k int, v string")
    assert rows(jsonlines.array_lines(spark, str(tmp_path / "a.json"), schema)) == [(1, "x"), (2, "y")]
    (tmp_path / "b.json").write_text('{"k": 1}\nbroken\n')
    assert jsonlines.json_lines(spark, str(tmp_path / "b.json"), schema).where("_corrupt is not null").count() == 1


def test_publish_writes_only_changes(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "t1"), ("b", 2, "t1"), ("bad/id", 3, "t1")], "id string, n int, at string")
    first = sinks.publish(spark, sinks.documents(df, "id", drop=("at",)), str(tmp_path / "s"))
    assert rows(first.select("key", "status")) == [("a", "new"), ("b", "new")]
    again = df.withColumn("at", F.lit("t2")).withColumn("n", F.when(F.col("id") == "b", 5).otherwise(F.col("n"))).where("id <> 'bad/id'")
    second = sinks.publish(spark, sinks.documents(again, "id", drop=("at",)), str(tmp_path / "s"))
    assert rows(second.select("key", "status")) == [("a", "same"), ("b", "changed")]


def test_dates_and_diff(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-05"), ("x", "2024-01-05"), ("2024-01-05", "2024-01-01")], "a string, b string")
    assert [r[0] for r in df.select(dates.days_between(F.col("a"), F.col("b"))).collect()] == [4, 1, 1]
    now = spark.createDataFrame([("m", "a", 4), ("m", "b", 1)], "board string, slug string, q int")
    base = spark.createDataFrame([("m", "a", 2), ("m", "c", 3)], "board string, slug string, q int")
    assert rows(diff.list_diff(now, base, ["board", "slug"], "q")) == [("m", "a", 2, 0), ("m", "b", 1, 0), ("m", "c", 0, 3)]


def test_constrained_fill_respects_limits(spark):
    from gleaner.operators import guides

    rows_ = [("g", f"c{i:02}", "land" if i % 2 else "spell", 1.0 - i / 100, "hard" if i < 4 else None) for i in range(12)]
    df = spark.createDataFrame(rows_, "g string, c string, role string, s double, flag string")
    got = [(r["pick"], r["c"]) for r in guides.fill(df, "g", "c", "role", "s", {"land": 2, "spell": 1}, 5, {"hard": 2}, "flag", {"x": {"c04", "c05"}}).orderBy("pick").collect()]
    assert got == [(1, "c00"), (2, "c01"), (3, "c05"), (4, "c06"), (5, "c07")]


def test_levels_and_nearest(spark):
    from gleaner.operators import guides

    df = spark.createDataFrame([("a", 1, 50), ("a", 2, 2), ("a", 3, 50), ("b", 5, 0)], "k string, level int, n int")
    assert rows(guides.levels(df, "k", "level", "n", 10)) == [("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("b", 5, 5)]
    have = spark.createDataFrame([("a", 1), ("a", 3)], "k string, level int")
    assert rows(guides.nearest_level(spark.createDataFrame([("a", 2)], "k string, level int"), have, "k", "level", "f")) == [("a", 2, 3)]


def test_empty_inputs_give_empty_results(spark):
    lines = spark.createDataFrame([], "g int, deck_id int, board string, slug string, qty long")
    assert tallies.consensus(lines, ["g"]).count() == tallies.profile(lines, ["g"]).count() == tallies.hand(lines, ["g"]).count() == 0
    series = spark.createDataFrame([], "k int, day date, v int")
    assert timeseries.filled(series, ["k"], "day", "v", "2024-01-01", "2024-01-02", 3).count() == 0
    e = spark.createDataFrame([], "a int, b int")
    assert graph.min_label(spark, e, "a", "b").count() == 0
    assert similarity.self_cosine(spark.createDataFrame([], "i int, s string, w double"), "i", ["s"]).count() == 0
