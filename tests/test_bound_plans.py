"""The queries without SQL against a plain pass over the rows that they are bound to."""

import math
from collections import defaultdict

from gleaner.operators import merging
from gleaner.plans import merging as bound, registry, relations, whole
from gleaner.plans.bindings import decks
from gleaner.session import table
from pyspark.sql import functions as F

from tests.test_rounds import plain


def test_merge_plan_and_assigned_results(spark, sf_dir):
    sizes, scores, lists = bound._inputs(spark, sf_dir)
    worlds = defaultdict(lambda: ([], {}, {}, {}, set(), []))
    for r in sizes.collect():
        ids, n, _, previous, _, always = worlds[r["group"]]
        ids.append(r["id"])
        n[r["id"]] = list(r["decks"])
        if (kind := r["id"].split("/")[1]) in ("HOUSEHOLD", "AUTOMOBILE"):
            always.append((r["id"].split("/")[0], r["id"]))
    for r in scores.collect():
        worlds[r["group"]][2][r["a"], r["b"]] = r["score"]
    for ids, _, _, previous, apart, _ in worlds.values():
        of = lambda k: [x for x in ids if x.endswith(k)]  # noqa: B023, E731
        previous.update({x: min(of("BUILDING")) for x in of("BUILDING")})
        apart.update((a, b) for a in of("MACHINERY") for b in of("FURNITURE"))
    want = {(g, x): v for g, w in worlds.items() for x, v in plain(*w).items()}
    got = {(r["group"], r["id"]): (r["leader"], r["how"], r["score"]) for r in registry.queries()["merge_plan"](spark, sf_dir).collect()}
    assert got == want

    profile = defaultdict(dict)
    for r in lists.collect():
        profile[r["group"], r["id"]][r["slug"]] = r["w"]
    results = defaultdict(dict)
    for r in bound._lists(spark, sf_dir).join(bound._rows(spark, sf_dir).where("id is null"), "deck_id").collect():
        x = results[r["group"], r["deck_id"]]
        x[r["slug"]] = x.get(r["slug"], 0) + r["q"]
    cosine = lambda a, b: sum(v * b.get(k, 0) for k, v in a.items()) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    near = {}
    for (g, item), x in results.items():
        best = max(((round(cosine(x, profile[g, i]), 12), worlds[g][1][i], i) for (h, i), (leader, *_) in want.items() if h == g and i == leader and profile[g, i]), default=None)
        if best and best[0] >= bound.ASSIGNED:
            near[g, item] = (best[2], round(best[0], 9))
    assigned = {(r["format"], r["deck_id"]): (r["leader"], r["score"]) for r in registry.queries()["merge_assigned"](spark, sf_dir).collect()}
    assert assigned == near and near

    report = {r["group"]: (r["pairs"], r["groups"], r["merged"], r["left"]) for r in registry.queries()["merge_report"](spark, sf_dir).collect()}
    free = bound._rows(spark, sf_dir).where("id is null").groupBy("group").count().collect()
    led = defaultdict(lambda: defaultdict(int))
    for (g, _), (leader, *_) in want.items():
        led[g][leader] += 1
    assert report == {g: (sum(s >= 0.7 for s in worlds[g][2].values()), sum(n > 1 for n in led[g].values()), sum(n - 1 for n in led[g].values()), {r["group"]: r["count"] for r in free}.get(g, 0) - sum(h == g for h, _ in near)) for g in worlds}
    assert merging.THRESHOLD == 0.8


def test_leader_clusters(spark, sf_dir):
    n = {(r["format"], r["archetype"]): r["count"] for r in decks(spark, sf_dir).groupBy("format", "archetype").count().collect()}
    v = defaultdict(dict)
    for r in whole._vectors(spark, sf_dir).collect():
        v[r["format"], r["archetype"]][r["slug"]] = r["w"]
    cosine = lambda a, b: sum(x * b.get(k, 0) for k, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    want = {}
    for f in {f for f, _ in n}:
        chosen = []
        for x in sorted((a for g, a in n if g == f), key=lambda a: (n[f, a], a), reverse=True):
            best = max(chosen, key=lambda y: cosine(v[f, x], v[f, y]), default=None)
            if best is None or cosine(v[f, x], v[f, best]) < 0.9:
                chosen.append(x)
                best = x
            want[f, x] = best
    assert {(r["format"], r["archetype"]): r["leader"] for r in registry.queries()["leader_clusters"](spark, sf_dir).collect()} == want


def test_greedy_name_pairs(spark, sf_dir):
    rows = relations.jaccard_names(spark, sf_dir).collect()
    used, want = set(), set()
    for r in sorted(rows, key=lambda r: (-r["similarity"], r["a"], r["b"])):
        if (r["t"], 0, r["a"]) not in used and (r["t"], 1, r["b"]) not in used:
            used |= {(r["t"], 0, r["a"]), (r["t"], 1, r["b"])}
            want.add((r["t"], r["a"], r["b"]))
    assert {(r["t"], r["a"], r["b"]) for r in registry.queries()["greedy_name_pairs"](spark, sf_dir).collect()} == want


def test_unions_with_apart(spark, sf_dir):
    sets: dict = defaultdict(dict)
    for r in table(spark, sf_dir, "part").orderBy("p_partkey").collect():
        s = sets[r["p_brand"]]
        p, q = (s.setdefault(x, {x}) for x in (r["p_name"], r["p_type"]))
        if p is not q and not any({x, y} == {"SMALL", "LARGE"} for x in p for y in q):
            p |= q
            s.update({x: p for x in q})
    want = {(b, x): min(p) for b, s in sets.items() for x, p in s.items()}
    assert {(r["p_brand"], r["name"]): r["root"] for r in registry.queries()["unions_with_apart"](spark, sf_dir).collect()} == want


def test_principal_axes_up_to_sign(spark, sf_dir):
    import numpy as np

    rows = table(spark, sf_dir, "embeddings").orderBy("vec_id").select("vec_id", F.col("embedding").cast("array<double>")).collect()
    x = np.array([r[1] for r in rows], np.float16).astype(float)
    mean = x.mean(0)
    axes = np.linalg.eigh((x - mean).T @ (x - mean) / len(x))[1][:, -8:]
    got = np.array([r["projected"] for r in registry.queries()["principal_axes"](spark, sf_dir).orderBy("vec_id").collect()])
    assert np.allclose(np.abs(got), np.abs((x - mean) @ axes), atol=1e-5)


def test_constrained_fill(spark, sf_dir):
    """The greedy fill of each archetype's pool, with the rules told one by one."""
    from gleaner.operators import guides
    from gleaner.plans.bindings import catalog
    from gleaner.plans.guides import _page_cards

    pool = guides.pool(_page_cards(spark, sf_dir), "archetype", "slug", 60).join(catalog(spark, sf_dir), "slug").select("archetype", "slug", "kind", "best", "color").collect()
    aims, combos, want = {"PROMO": 3, "SMALL": 4, "LARGE": 2}, [{"red-ring", "red-rod"}, {"hot-plate", "old-plate"}], []
    for archetype in {r["archetype"] for r in pool}:
        rows = sorted((r for r in pool if r["archetype"] == archetype), key=lambda r: (-r["best"], r["slug"]))
        deck = []
        for step in (1, 2):
            for r in rows:
                names = {x["slug"] for x in deck}
                if len(deck) == 20 or r["slug"] in names or step == 1 and sum(x["kind"] == r["kind"] for x in deck) >= aims.get(r["kind"], 0):
                    continue
                if r["color"] == 0 and sum(x["color"] == 0 for x in deck) >= 3 or any(r["slug"] in c and c <= names | {r["slug"]} for c in combos):
                    continue
                deck.append(r)
        want += [(archetype, i, r["slug"], r["kind"]) for i, r in enumerate(deck, 1)]
    got = [(r["archetype"], r["pick"], r["slug"], r["role"]) for r in registry.queries()["constrained_fill"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


def test_longest_paragraph(spark, sf_dir):
    """Of all paragraphs of a page the longest, the first of equals; pages without any have no row."""
    from gleaner.sources import html

    pages = {r["page_id"]: r["html"] for r in table(spark, sf_dir, "pages").collect()}
    want = {}
    for k, page in pages.items():
        found = [r[1] for r in html.parsed(page) if r[0] == "p" and r[4] < 0.9]
        if found:
            want[k] = max(found, key=len)
    assert {r["page_id"]: r["text"] for r in registry.queries()["longest_paragraph"](spark, sf_dir).collect()} == want
