"""Filled decks against a plain fill that checks every rule on whole sets."""

import random
from collections import defaultdict
from types import SimpleNamespace

import pytest

from gleaner.operators import filling
from gleaner.plans import filling as bound, registry

CARDS = "deck string, card string, role string, score double, synergy double, mana_value double, mana_cost string, game_changer boolean, extra_turn boolean, mass_land_denial boolean"
FIELDS = [x.split()[0] for x in CARDS.split(", ")]
ROOM = {"game_changer": [0, 0, 3], "extra_turn": [0, 2, 2], "mass_land_denial": [0, 0, 0]}


def plain(cards, level, slots, colors, nonbasic, combos, who):
    """cards: namespaces; combos: sets of names above the level. Returns names in order, basics, land target."""
    colors = [c for c in "WUBRG" if c in (colors or "")]
    order = sorted(cards, key=lambda c: (-(c.score or 0), -(c.synergy or 0), c.card))
    deck = []

    def allowed(c):
        names = {x.card for x in deck} | who | {c.card}
        full = any(getattr(c, f) and level <= 3 and sum(bool(getattr(x, f)) for x in deck) >= ROOM[f][level - 1] for f in ROOM)
        return not full and c.card not in {x.card for x in deck} and not any(c.card in s and s <= names for s in combos)

    def take(some, count):
        for c in some:
            if count > 0 and allowed(c):
                deck.append(c)
                count -= 1

    def target(some):
        spells = [c for c in some if c.role != "land"]
        mean = sum(c.mana_value or 0 for c in spells) / len(spells) if spells else 0
        return 36 - (sum(c.role == "ramp" for c in deck) >= 12) + (mean > 3.5)

    for roles, n in ((["ramp"], 10), (["draw"], 10), (["removal", "counter"], 10), (["wipe"], 3), (["protection"], 3)):
        take([c for c in order if c.role in roles], n)
    steps = list(deck)
    rest = [c for c in order if c.role in ("payoff", "engine", "tutor", "combo", "utility")]
    n = max(0, slots - target(steps) - len(steps))
    lands = target(steps + [c for c in rest if c not in deck][:n])
    take(rest, max(0, slots - lands - len(steps)))
    take([c for c in order if c.role == "land"], min(lands, lands if nonbasic is None or not colors else nonbasic))
    take([c for c in order if c.role != "land"], slots - lands - sum(c.role != "land" for c in deck))
    if not colors:
        take(order, slots - len(deck))
    left, split = slots - len(deck), {}
    if left > 0 and colors:
        pips = {c: sum(c in s for x in deck if x.role != "land" for s in (x.mana_cost or "").split("}")) for c in colors}
        pips = pips if sum(pips.values()) else dict.fromkeys(colors, 1)
        share = {c: left * p / sum(pips.values()) for c, p in pips.items()}
        split = {c: int(share[c]) for c in colors}
        for c in sorted(colors, key=lambda c: split[c] - share[c])[: left - sum(split.values())]:
            split[c] += 1
    return [c.card for c in deck], {c: n for c, n in split.items() if n}, lands


def results(df):
    out = defaultdict(lambda: ([], {}, None))
    for r in df.orderBy("deck", "pick").collect():
        cards, lands, _ = out[r["deck"]]
        if r["role"] == "basic":
            lands[r["card"]] = r["copies"]
        else:
            cards.append(r["card"])
        out[r["deck"]] = (cards, lands, r["land_target"])
    return dict(out)


def test_random_decks(spark):
    rng = random.Random(13)
    roles = ["land", "ramp", "draw", "removal", "counter", "wipe", "protection", "payoff", "engine", "tutor", "utility"]
    rows, decks, who, combos, want = [], [], [], [], {}
    for i in range(60):
        combos += [(f"c{i}", c, 1 + i % 5) for c in rng.sample([f"n{k:03}" for k in range(160)], rng.choice([1, 2, 2, 3]))]
    sets, bracket = defaultdict(set), {}
    for c, card, b in combos:
        sets[c].add(card)
        bracket[c] = b
    for d in range(14):
        name, level, slots = f"d{d}", d % 5 + 1, rng.choice([20, 60, 99])
        names = rng.sample([f"n{k:03}" for k in range(160)], rng.choice([0, 10, 140]))
        cards = [(name, c, rng.choice(roles), rng.choice([None, 0.1, 0.5, 0.9]), rng.choice([None, 0.0, 0.3]), rng.choice([None, 1.0, 4.0, 7.0]), rng.choice([None, "", "{W}{U}", "{B/R}", "{2}{G}"]), rng.random() < 0.1, rng.random() < 0.1, rng.choice([None, False, True])) for c in names[2:]]
        colors, nonbasic = rng.choice(["", None, "G", "UW", "WUBRG"]), rng.choice([None, 0, 5])
        rows += cards
        decks.append((name, level, slots, colors, nonbasic))
        who += [(name, c) for c in names[:2]]
        got = plain([SimpleNamespace(**dict(zip(FIELDS, c))) for c in cards], level, slots, colors, nonbasic, [s for c, s in sets.items() if bracket[c] > level], set(names[:2]))
        if got[0] or got[1]:
            want[name] = got
    frame = spark.createDataFrame
    out = filling.fill(frame(rows, CARDS), frame(decks, "deck string, level int, slots int, colors string, nonbasic int"), frame(who, "deck string, card string"), frame(combos, "combo string, card string, bracket int"))
    assert results(out) == want and len(want) > 8


def test_query_against_a_plain_fill(spark, sf_dir):
    pool, decks, who, combos = (df.collect() for df in bound.inputs(spark, sf_dir))
    cards, leads, sets, bracket = defaultdict(list), defaultdict(set), defaultdict(set), {}
    for r in pool:
        cards[r["deck"]].append(SimpleNamespace(**{f: r[f] for f in FIELDS}))
    for r in who:
        leads[r["deck"]].add(r["card"])
    for r in combos:
        sets[r["combo"]].add(r["card"])
        bracket[r["combo"]] = r["bracket"]
    got = results(registry.queries()["filled_decks"](spark, sf_dir))
    for r in decks:
        names = {c.card for c in cards[r["deck"]]} | leads[r["deck"]]
        above = [s for c, s in sets.items() if bracket[c] > r["level"] and s <= names]
        assert got[r["deck"]] == plain(cards[r["deck"]], r["level"], r["slots"], r["colors"], r["nonbasic"], above, leads[r["deck"]])


@pytest.mark.parametrize(
    ("count", "costs", "colors", "want"),
    [(10, ["{W}{W}", "{1}{U}", "{W/U}"], "WU", {"W": 6, "U": 4}), (5, [], "WUB", {"W": 2, "U": 2, "B": 1}), (5, ["{G}"], "", {}), (0, ["{G}"], "G", {}), (3, ["{G}"], "WG", {"G": 3})],
)
def test_basics(count, costs, colors, want):
    assert filling.basics(count, costs, colors) == want


def test_brackets(spark):
    """Each rule alone and the greatest of them; commanders help to hold a combination but their flags don't count."""
    frame = spark.createDataFrame
    decks = {"a": ["x"], "b": ["g1"], "c": ["g1", "g2", "g3", "g4"], "d": ["m", "t1"], "e": ["t1"], "f": ["t1", "t2", "t3"], "g": ["p", "g1"], "h": ["p", "q"], "i": ["unknown"]}
    flags = [("x", None, False, False), *((f"g{i}", True, False, False) for i in range(1, 5)), ("m", False, False, True), *((f"t{i}", False, True, False) for i in range(1, 4)), ("boss", True, True, True)]
    out = filling.brackets(frame([(d, c) for d, cs in decks.items() for c in cs * 2], "deck string, card string"), frame([("g", "boss"), ("z", "boss")], "deck string, card string"), frame(flags, "card string, game_changer boolean, extra_turn boolean, mass_land_denial boolean"), frame([("k", "p", 3), ("k", "boss", 3), ("l", "p", 2), ("l", "q", 2), ("n", "boss", 5), ("n", "q", 5)], "combo string, card string, bracket int"))
    assert {r["deck"]: r["bracket"] for r in out.collect()} == {"a": 1, "b": 3, "c": 4, "d": 4, "e": 2, "f": 4, "g": 3, "h": 2, "i": 1}
    assert {r["deck"]: r["game_changers"] for r in out.collect()}["g"] == 1


def test_brackets_of_nested_decks(spark):
    """Each level of nested decks is what brackets says of the deck by itself."""
    rng = random.Random(21)
    cards = [f"n{k:02}" for k in range(24)]
    have = [(s, c, rng.randint(1, 5), False) for s in range(9) for c in rng.sample(cards, 8)]
    have = [(s, c, 1, True) if i % 8 == 0 else (s, c, n, lead) for i, (s, c, n, lead) in enumerate(have)]
    flags = [(c, rng.random() < 0.3, rng.random() < 0.2, rng.random() < 0.1) for c in cards[2:]]
    combos = [(f"c{i}", c, 2 + i % 4) for i in range(120) for c in rng.sample(cards, rng.choice([1, 2, 2, 3]))]
    frame = spark.createDataFrame
    flags, combos = frame(flags, "card string, game_changer boolean, extra_turn boolean, mass_land_denial boolean"), frame(combos, "combo string, card string, bracket int")
    each = lambda main: frame([(f"{s}/{n}", c) for s, c, first, lead in have for n in range(first, 6) if lead != main], "deck string, card string")
    want = {tuple(r) for r in filling.brackets(each(True), each(False), flags, combos).collect()}
    out = filling.nested_brackets(frame(have, "style int, card string, from int, lead boolean"), flags, combos, 5).collect()
    assert {(f"{r[0]}/{r[1]}", *r[2:]) for r in out} == want and len(out) == len(want) > 30 and {r[-1] for r in want} >= {1, 3, 4}
