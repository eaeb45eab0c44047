"""Passes in order, in rounds and in one task, against the plain pass on random graphs."""

import random

import pytest

from gleaner.operators import graph, matching, merging, similarity

SCORES = "group string, a string, b string, score double, days int"


def random_plan(rng, n):
    ids = [f"x{i:02}" for i in range(n)]
    sizes = {x: [rng.randint(0, 6), rng.randint(0, 3)] for x in ids}
    scores = {tuple(sorted(p)): rng.choice([0.5, 0.74, 0.75, 0.79, 0.8, 0.85, 0.9]) for p in (rng.sample(ids, 2) for _ in range(3 * n))}
    previous = {x: rng.choice(ids[: n // 3] + ["gone"]) for x in rng.sample(ids, n // 2)}
    apart = {tuple(rng.sample(ids, 2)) for _ in range(n // 3)}
    always = [(r, x) for r in "pq" for x in rng.sample([*ids, "gone"], 3)]
    return ids, sizes, scores, previous, apart, always


def plain(ids, sizes, scores, previous, apart, always):
    """The pass as it is told, biggest first."""
    size = lambda x: (sizes[x], x)
    score = lambda x, y: scores.get(tuple(sorted((x, y))), 0.0)
    foes = apart | {(b, a) for a, b in apart}
    rules = {}
    for r, x in always:
        rules.setdefault(r, set()).add(x)
    leader, how, stay = {}, {}, {}
    for was in sorted({y for x, y in previous.items() if x in sizes and y in sizes}, key=size, reverse=True):
        there = [x for x in ids if previous.get(x) == was and x != was]
        if there:
            top = max(there, key=size)
            leads = top if sizes[top][0] > merging.MARGIN * sizes[was][0] else was
            leader[leads], how[leads] = leads, "leads"
            stay.update({x: leads for x in [was, *there] if x != leads})
    fits = lambda x, y: not any((x, z) in foes for z, l in leader.items() if l == y)
    for x in sorted(ids, key=size, reverse=True):
        if x in leader:
            continue
        wanted = [leader[y] for r in sorted(rules) if x in rules[r] for y in sorted(rules[r] & set(ids) - {x}, key=size, reverse=True) if y in leader]
        forced = next((y for y in wanted if fits(x, y)), None)
        near = max(((score(x, y), size(y), y) for y in set(leader.values()) if fits(x, y)), default=(0, None, None))
        if forced:
            leader[x], how[x] = forced, "forced"
        elif x in stay and fits(x, stay[x]) and score(x, stay[x]) >= merging.STICKY:
            how[x] = "joined" if score(x, stay[x]) >= merging.THRESHOLD else "kept"
            leader[x] = stay[x]
        elif near[0] >= merging.THRESHOLD:
            leader[x], how[x] = near[2], "joined"
        else:
            leader[x], how[x] = x, "leads"
    return {x: (leader[x], how[x], 1.0 if leader[x] == x else score(x, leader[x])) for x in ids}


def frames(spark, worlds):
    rows = lambda f, ddl: spark.createDataFrame([(g, *r) for g, w in worlds.items() for r in f(*w)], f"group string, {ddl}")
    return (
        rows(lambda ids, sizes, *_: [(x, sizes[x]) for x in ids], "id string, decks array<long>"),
        rows(lambda i, z, scores, *_: [(*p, s, 30) for p, s in scores.items()], "a string, b string, score double, days int"),
        rows(lambda i, z, s, previous, *_: list(previous.items()), "id string, leader string"),
        rows(lambda i, z, s, p, apart, a: list(apart), "a string, b string"),
        rows(lambda i, z, s, p, a, always: always, "rule string, id string"),
    )


@pytest.mark.parametrize("most", [10**9, 0, 40])
def test_merge_plans(spark, most):
    """One task a group, rounds for all groups, and both."""
    rng = random.Random(21)
    worlds = {f"g{i}": random_plan(rng, rng.choice([6, 12, 20])) for i in range(24)}
    got: dict = {}
    for r in merging.planned(*frames(spark, worlds), most=most).collect():
        got.setdefault(r["group"], {})[r["id"]] = (r["leader"], r["how"], r["score"])
    want = {g: plain(*w) for g, w in worlds.items()}
    assert got == want
    assert {h for w in want.values() for _, h, _ in w.values()} == {"leads", "joined", "kept", "forced"}


def test_a_large_group_is_settled_in_rounds(spark):
    """What one task was refused before: a group of more scored pairs than it may hold."""
    sizes = spark.createDataFrame([("g", "a", [3]), ("g", "b", [2]), ("g", "c", [1])], "group string, id string, decks array<long>")
    scores = spark.createDataFrame([("g", "a", "b", 0.9, 30), ("g", "b", "c", 0.95, 7), ("g", "a", "c", None, 7)], SCORES)
    empty = lambda ddl: spark.createDataFrame([], f"group string, {ddl}")
    out = merging.planned(sizes, scores, empty("id string, leader string"), empty("a string, b string"), empty("rule string, id string"), most=1)
    assert {r["id"]: (r["leader"], r["score"], r["days"]) for r in out.collect()} == {"a": ("a", 1.0, 0), "b": ("a", 0.9, 30), "c": ("c", 1.0, 0)}


def test_disabled_groups_stay_unmerged(spark):
    sizes = spark.createDataFrame([(g, x, [n]) for g in "gh" for x, n in (("a", 3), ("b", 2))], "group string, id string, decks array<long>")
    scores = spark.createDataFrame([(g, "a", "b", 0.9, 30) for g in "gh"], SCORES)
    empty = lambda ddl: spark.createDataFrame([], f"group string, {ddl}")
    out = merging.planned(sizes, scores, empty("id string, leader string"), empty("a string, b string"), empty("rule string, id string"), spark.createDataFrame([("h",)], "group string"))
    assert sorted((r["group"], r["id"], r["leader"]) for r in out.collect()) == [("g", "a", "a"), ("g", "b", "a"), ("h", "a", "a"), ("h", "b", "b")]


def test_results_join_the_nearest_leader(spark):
    """Ties to the bigger leader, none below the threshold, members' lists don't count, results without a list have no row."""
    plan = spark.createDataFrame([("g", "a", "a"), ("g", "b", "b"), ("g", "m", "b"), ("h", "a", "a")], "group string, id string, leader string")
    sizes = spark.createDataFrame([("g", "a", [1]), ("g", "b", [2]), ("g", "m", [9]), ("h", "a", [1])], "group string, id string, decks array<long>")
    lists = spark.createDataFrame([("g", "a", "x", 4), ("g", "b", "x", 2), ("g", "m", "y", 4), ("h", "a", "z", 1)], "group string, id string, slug string, w int")
    found = spark.createDataFrame([("g", 1, "x", 3), ("g", 2, "y", 3), ("h", 3, "z", 1), ("h", 3, "q", 3), ("h", 4, "z", 2), ("k", 5, "z", 2)], "group string, item int, slug string, w int")
    got = sorted((r["group"], r["item"], r["leader"], r["score"]) for r in merging.assigned(plan, sizes, lists, found).collect())
    assert got == [("g", 1, "b", 1.0), ("h", 4, "a", 1.0)]


@pytest.mark.parametrize("most", [10**9, 0])
def test_leaders(spark, most):
    rng = random.Random(5)
    sizes, scores, want = [], [], []
    for g in range(12):
        ids = [f"{g}-{i:02}" for i in range(18)]
        n = {x: rng.randint(1, 5) for x in ids}
        near = {tuple(sorted(rng.sample(ids, 2))): rng.choice([0.7, 0.8, 0.9, 0.95]) for _ in range(40)}
        sizes += [(g, x, k) for x, k in n.items()]
        scores += [(g, *p, c) for p, c in near.items()]
        chosen = []
        for x in sorted(ids, key=lambda x: (n[x], x), reverse=True):
            best = max(chosen, key=lambda y: near.get(tuple(sorted((x, y))), 0), default=None)
            if best is None or near.get(tuple(sorted((x, best))), 0) < 0.8:
                chosen.append(x)
                best = x
            want.append((g, x, best))
    out = similarity.leaders(spark.createDataFrame(sizes, "g int, i string, n int"), spark.createDataFrame(scores, "g int, a string, b string, cosine double"), "g", "i", "n", 0.8, most)
    assert sorted(map(tuple, out.collect())) == sorted(want)


@pytest.mark.parametrize("most", [10**9, 0, 30])
def test_greedy_pairs(spark, most):
    rng = random.Random(6)
    rows = [(g, rng.randint(0, 8), rng.randint(0, 8), rng.choice([None, 0.1, 0.5, 0.5, 0.9]), rng.randint(0, 9)) for g in range(6) for _ in range(rng.choice([5, 60]))]
    rows += [(9, i, i + d, 100.0 - 2 * i - d, 0) for i in range(12) for d in (0, 1)]  # a chain: one pair a round
    best: dict = {}
    for g, a, b, s, _ in rows:
        best[g, a, b] = max(best.get((g, a, b), -1.0), -1.0 if s is None else s)
    want, used = [], set()
    for (g, a, b), s in sorted(best.items(), key=lambda x: (-x[1], x[0][1], x[0][2])):
        if (g, "a", a) not in used and (g, "b", b) not in used:
            used |= {(g, "a", a), (g, "b", b)}
            want.append((g, a, b))
    df = spark.createDataFrame(rows, "g int, a int, b int, s double, other int")
    assert sorted((r["g"], r["a"], r["b"]) for r in matching.greedy_pairs(df, "g", "a", "b", "s", most).collect()) == sorted(want)


def test_unions_by_components(spark):
    """Sets of names, the smallest name their root, as the plain pass over all edges of a group gives them."""
    rng = random.Random(7)
    edges, apart, want = [], [], {}
    for g in range(8):
        names = [f"n{i:02}" for i in range(30)]
        mine = [(g, i, *rng.sample(names, 2)) for i in range(28)]
        foes = {tuple(rng.sample(names, 2)) for _ in range(g)}
        edges += mine + mine[:3]
        apart += [(g, *f) for f in foes]
        sets = {x: {x} for _, _, a, b in mine for x in (a, b)}
        for _, _, a, b in mine:
            p, q = sets[a], sets[b]
            if p is not q and not any((x, y) in foes or (y, x) in foes for x in p for y in q):
                p |= q
                for x in q:
                    sets[x] = p
        want |= {(g, x): min(s) for x, s in sets.items()}
    out = graph.union_with_apart(spark.createDataFrame(edges, "g int, ord int, a string, b string"), spark.createDataFrame(apart, "g int, a string, b string"), "g")
    assert {(r["g"], r["name"]): r["root"] for r in out.collect()} == want


def test_projection_keeps_nulls(spark):
    rows = [(i, [float(i), float(i % 3)]) for i in range(20)] + [(99, None)]
    out = {r["i"]: r["projected"] for r in similarity.projected(spark.createDataFrame(rows, "i int, v array<double>"), "v", 2, 1).collect()}
    assert out[99] is None and len(out) == 21 and all(len(v) == 1 for i, v in out.items() if i != 99)


def test_components_of_chains_stars_and_loops(spark):
    """A chain of 400 in random order, stars, loops, repeated and null edges, against a plain search."""
    rng = random.Random(12)
    ids = list(range(400))
    rng.shuffle(ids)
    edges = list(zip(ids, ids[1:])) + [(1000 + k % 3, 1100 + k) for k in range(60)] + [(5000, 5000), (5001, 5002), (5002, 5001), (None, 7), (8, None)] + [(2000 + rng.randint(0, 99), 2000 + rng.randint(0, 99)) for _ in range(45)]
    near: dict = {}
    for a, b in edges:
        if a is not None and b is not None:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for x in sorted(near):
        todo = [x]
        while todo:
            y = todo.pop()
            if y not in want:
                want[y] = x
                todo += near[y]
    got = graph.min_label(spark, spark.createDataFrame(edges * 2, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["label"] for r in got} == want and len(got) == len(want)
