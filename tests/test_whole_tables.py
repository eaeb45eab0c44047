"""Queries over decks and lines take part of every deck, archetype and line; their rows are held against SQL in test_queries."""

import math
from collections import defaultdict

from pyspark.sql import GroupedData

from gleaner.operators import graph
from gleaner.plans import registry
from gleaner.plans.bindings import DECKS, LINES

ALL = registry.queries()


def test_leader_clusters_of_all_decks_equal_brute_force(spark, duck, sf_dir):
    vectors = defaultdict(lambda: defaultdict(int))
    for a, s, w in duck.sql(f"WITH {DECKS}, {LINES} SELECT archetype, slug, sum(least(qty, 4)) FROM decks JOIN lines USING (deck_id) GROUP BY 1, 2").fetchall():
        vectors[a][s] = int(w)
    cosine = lambda x, y: sum(w * y.get(s, 0) for s, w in x.items()) / math.sqrt(sum(w * w for w in x.values()) * sum(w * w for w in y.values()))
    want, leaders = {}, defaultdict(list)
    for f, a, _ in duck.sql(f"WITH {DECKS} SELECT format, archetype, count(*) AS n FROM decks GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2").fetchall():
        best = max(leaders[f], key=lambda y: cosine(vectors[a], vectors[y]), default=None)
        if best is None or cosine(vectors[a], vectors[best]) < 0.9:
            leaders[f].append(best := a)
        want[f, a] = best
    assert {(r["format"], r["archetype"]): r["leader"] for r in ALL["leader_clusters"](spark, sf_dir).collect()} == want


def test_every_deck_and_archetype_takes_part(spark, duck, sf_dir):
    ((listed,),) = duck.sql(f"WITH {LINES} SELECT count(DISTINCT deck_id) FROM lines JOIN orders ON o_orderkey = deck_id").fetchall()
    assert ALL["nearest_profile"](spark, sf_dir).select("deck_id").distinct().count() > 0.9 * listed
    both = {r[0] for r in duck.sql(f"WITH {DECKS} SELECT archetype FROM decks JOIN lineitem ON l_orderkey = deck_id WHERE year(ts) = 1998 INTERSECT SELECT archetype FROM decks JOIN lineitem ON l_orderkey = deck_id WHERE year(ts) = 1997").fetchall()}
    assert {r[0] for r in ALL["list_differences"](spark, sf_dir).select("archetype").distinct().collect()} >= both


def test_signatures_take_all_lines(spark, tmp_path):
    """Orders that agree in their lines numbered 1 only are not the same set; one without such a line counts."""
    rows = [(1, 1, 7), (1, 2, 8), (2, 1, 7), (3, 2, 8), (3, 3, 7)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = ALL["set_signatures"](spark, str(tmp_path)).collect()
    assert [tuple(r[c] for c in ("signature", "kept", "dropped")) for r in got] == [("7|8", 1, 1)]


def test_deep_chains_have_roots(spark):
    """A chain of 300 parents, one circle of three, and one node whose parent is not a row."""
    rows = [(i, i - 1 if i else None) for i in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 5)]
    got = {r["node"]: r["root"] for r in graph.roots(spark, spark.createDataFrame(rows, "n long, p long"), "n", "p").collect()}
    assert got == {**{i: 0 for i in range(300)}, 1000: None, 1001: None, 1002: None, 2000: 0}


def test_repeated_edges_are_sent_once(spark, monkeypatch):
    """300 edges, three of them distinct, reach the group's task as three rows, with the roots of the first of each."""
    sent = {}
    cogroup = GroupedData.cogroup

    def seen(self, other):
        sent["rows"] = self._df.count()
        return cogroup(self, other)

    monkeypatch.setattr(GroupedData, "cogroup", seen)
    e = spark.createDataFrame([("g", i, *("ab", "bc", "cd")[i % 3]) for i in range(300)], "g string, ord int, a string, b string")
    apart = spark.createDataFrame([("g", "a", "c")], "g string, a string, b string")
    got = {r["name"]: r["root"] for r in graph.union_with_apart(e, apart, "g").collect()}
    assert sent["rows"] == 3 and got["a"] == got["b"] != got["c"] == got["d"]
