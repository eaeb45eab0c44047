"""Decks filled in steps under the rules of their level, and the level whose rules a finished deck keeps."""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner.operators.containment import contained, holding, set_classes
from gleaner.session import brought, ship, written

#: Steps with an aim in their order, roles that take what is left, lands of a deck, and colours in their order.
STEPS = ((("ramp",), 10), (("draw",), 10), (("removal", "counter"), 10), (("wipe",), 3), (("protection",), 3))
PAYOFFS = ("payoff", "engine", "tutor", "combo", "utility")
LANDS, COLORS = 36, "WUBRG"
#: How many cards with a flag a level allows; none listed: any number.
LIMITS = {"game_changer": {1: 0, 2: 0, 3: 3}, "extra_turn": {1: 0, 2: 2, 3: 2}, "mass_land_denial": {1: 0, 2: 0, 3: 0}}
FLAGS = tuple(LIMITS)


def land_target(ramp: int, spells: list) -> int:
    """One land less from twelve ramp cards on, one more if the spells cost more than 3.5 on average."""
    cost = sum(c.mana_value for c in spells) / len(spells) if spells else 0.0
    return LANDS - (ramp >= 12) + (cost > 3.5)


def basics(count: int, costs: list[str], colors: str) -> dict[str, int]:
    """count basic lands over colors by the spells' symbols (evenly if there are none), whole parts first, then the largest
    remainders, of equals the earlier colour."""
    if count <= 0 or not colors:
        return {}
    symbols = [s for cost in costs for s in cost.split("}")]
    pips = [sum(c in s for s in symbols) for c in colors]
    pips = pips if any(pips) else [1] * len(colors)
    shares = [count * p / sum(pips) for p in pips]
    whole = [math.floor(s) for s in shares]
    rest = sorted(range(len(colors)), key=lambda i: whole[i] - shares[i])[: count - sum(whole)]
    return {c: n for i, c in enumerate(colors) if (n := whole[i] + (i in rest))}


class _Table:
    """The cards chosen so far, what each flag has left, and how many cards each combination above the level still lacks."""

    def __init__(self, level: int, combos: dict[str, set[str]], commanders: set[str]):
        self.chosen, self.names = [], set()
        self.room = {f: LIMITS[f].get(level, math.inf) for f in FLAGS}
        self.lacks = {c: cards - commanders for c, cards in combos.items()}
        self.of = defaultdict(list)
        for c, cards in self.lacks.items():
            for card in cards:
                self.of[card].append(c)

    def fits(self, card) -> bool:
        full = any(getattr(card, f) and self.room[f] <= 0 for f in FLAGS)
        return not full and card.card not in self.names and not any(len(self.lacks[c]) == 1 for c in self.of[card.card])

    def take(self, cards: list, count: int) -> None:
        for card in cards:
            if count <= 0:
                return
            if self.fits(card):
                count -= 1
                self.chosen.append(card)
                self.names.add(card.card)
                for f in FLAGS:
                    self.room[f] -= bool(getattr(card, f))
                for c in self.of[card.card]:
                    self.lacks[c].discard(card.card)

    def spells(self) -> list:
        return [c for c in self.chosen if c.role != "land"]


def filled(cards: list, level: int, slots: int, colors: str, nonbasic: int | None, combos: dict[str, set[str]], commanders: set[str]) -> tuple[list, dict[str, int], int]:
    """(cards in the order taken, basics, land target). cards come best first."""
    table = _Table(level, combos, commanders)
    of = lambda *roles: [c for c in cards if c.role in roles]
    for roles, aim in STEPS:
        table.take(of(*roles), aim)
    steps = list(table.chosen)
    ramp = sum(c.role == "ramp" for c in steps)
    open_ = lambda target: max(0, slots - target - len(steps))
    payoffs = of(*PAYOFFS)
    target = land_target(ramp, table.spells())
    likely = [c for c in payoffs if c.card not in table.names][: open_(target)]
    target = land_target(ramp, [c for c in steps + likely if c.role != "land"])
    table.take(payoffs, open_(target))
    table.take(of("land"), target if nonbasic is None or not colors else min(target, nonbasic))
    table.take([c for c in cards if c.role != "land"], slots - target - len(table.spells()))
    if not colors:
        table.take(cards, slots - len(table.chosen))
    return table.chosen, basics(slots - len(table.chosen), [c.mana_cost for c in table.spells()], colors), target


def fill(candidates: DataFrame, decks: DataFrame, commanders: DataFrame, combos: DataFrame) -> DataFrame:
    """deck, pick, card, role, copies, land_target: the cards of each deck in the order they were taken, then its basic lands.

    candidates: deck, card, role, score, synergy, mana_value, mana_cost and the FLAGS; the best first by score, then synergy, then
    name. decks: deck, level, slots, colors, nonbasic (null: as many as there is room for). commanders: deck, card. combos:
    combo, card, bracket.

    Each step with an aim takes its best cards; the land target follows from the ramp and the cost of what is taken, then again with the payoffs
    that would come; payoffs fill what the lands leave, then come lands, what is missing from any role, and basics. A card is passed over if its
    flag has no room at the level, or if it would complete a combination of a higher bracket. Only combinations that the pool and
    commanders hold whole go to a deck's task, looked for once for all decks with the same cards; a choice depends on those before it, so a deck is one task, and its pool is bounded by how it was made.
    """
    combos = written(combos.select("combo", "card", "bracket"))
    pool = candidates.select("deck", "card").union(commanders.select("deck", "card")).distinct()
    classes = written(set_classes(pool, "deck", "card"))
    first = pool.join(classes.where("deck = class"), "deck", "left_semi")
    held = contained(combos.select("combo", "card"), first, "combo", "deck", "card").select(F.col("deck").alias("class"), "combo").join(classes, "class")
    levels = decks.select("deck", F.col("level").alias("_level"))
    above = held.join(levels, "deck").join(combos.groupBy("combo").agg(F.max("bracket").alias("_bracket")), "combo").where("_bracket > _level")
    parts = above.select("deck", "combo").join(combos.select("combo", "card"), "combo")
    kinds = {"kind": "string", "combo": "string", "card": "string", "role": "string", "score": "double", "synergy": "double", "mana_value": "double", "mana_cost": "string", **{f: "boolean" for f in FLAGS}, "level": "int", "slots": "int", "colors": "string", "nonbasic": "int"}

    def rows(df: DataFrame, kind: str) -> DataFrame:
        return df.select("deck", *(F.lit(kind).alias(c) if c == "kind" else (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))

    known = {"score": 0.0, "synergy": 0.0, "mana_value": 0.0, "mana_cost": "", "role": "utility", **{f: False for f in FLAGS}}
    candidates = candidates.withColumns({c: F.coalesce(F.col(c).cast(kinds[c]), F.lit(v)) for c, v in known.items()})
    everything = rows(candidates, "card").unionByName(rows(commanders, "commander")).unionByName(rows(parts, "combo")).unionByName(rows(decks, "deck"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        of = {k: g for k, g in pdf.groupby("kind")}
        columns = ["deck", "pick", "card", "role", "copies", "land_target"]
        if "deck" not in of:
            return pd.DataFrame(columns=columns)
        deck = of["deck"].iloc[0]
        cards = of["card"] if "card" in of else pdf.iloc[:0]
        cards = cards.sort_values(["score", "synergy", "card"], ascending=[False, False, True])
        lists = {c: set(g["card"]) for c, g in of["combo"].groupby("combo")} if "combo" in of else {}
        colors = "".join(c for c in COLORS if c in (deck["colors"] or ""))
        nonbasic = None if pd.isna(deck["nonbasic"]) else int(deck["nonbasic"])
        chosen, lands, target = filled(list(cards.itertuples(index=False)), int(deck["level"]), int(deck["slots"]), colors, nonbasic, lists, set(of["commander"]["card"]) if "commander" in of else set())
        out = [(c.card, c.role, 1) for c in chosen] + [(c, "basic", n) for c, n in lands.items()]
        return pd.DataFrame([(deck["deck"], i, *row, target) for i, row in enumerate(out, 1)], columns=columns)

    ship(candidates.sparkSession)
    return everything.groupBy("deck").applyInPandas(run, f"deck {dict(decks.dtypes)['deck']}, pick int, card string, role string, copies int, land_target int")


def brackets(cards: DataFrame, commanders: DataFrame, flags: DataFrame, combos: DataFrame) -> DataFrame:
    """deck, the number of its cards with each flag, and bracket: the greatest level that a rule or a combination it holds asks for.

    cards: deck, card, without commanders; flags: card and the FLAGS; combos: combo, card, bracket, held with the commanders' help.
    """
    of = lambda df, lead: df.select(F.col("deck").alias("style"), "card", F.lit(lead).alias("lead"))
    have = of(cards, False).union(of(commanders, True)).groupBy("style", "card").agg(F.lit(1).alias("from"), F.bool_and("lead").alias("lead"))
    return nested_brackets(have, flags, combos).withColumnRenamed("style", "deck").drop("level")


def nested_brackets(have: DataFrame, flags: DataFrame, combos: DataFrame, until: int = 1, often: DataFrame | None = None) -> DataFrame:
    """style, level, the number of cards with each flag, and bracket, of every deck with a card besides commanders.

    have: style, card (once a style), from, lead (a commander): a style's deck of level n, up to `until`, holds the cards with from <= n. flags, combos: as
    brackets takes them; often: as containment.holding takes it. Combinations are looked for once in all cards of a style; where have is dealt by
    style, nothing of it is shuffled.
    """
    up = lambda c: F.explode(F.sequence(c, F.lit(until))).alias("level")
    count = lambda f: F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f"{f}s")
    flags = brought(flags.select("card", *FLAGS))
    counts = have.where(~F.col("lead")).join(flags, "card", "left").select("style", up("from"), *FLAGS).groupBy("style", "level").agg(*map(count, FLAGS))
    decks = have.groupBy("style").agg(F.collect_list("card").alias("_c"), F.collect_list("from").alias("_f"))
    sets = combos.groupBy("combo").agg(F.collect_set("card").alias("_cards"), F.max("bracket").cast("int").alias("_b"))
    first = F.array_max(F.transform("_cards", lambda c: F.get("_f", (F.array_position("_c", c) - 1).cast("int"))))
    held = holding(decks, "_c", sets, "combo", "_cards", often).select("style", "_b", first.alias("from"))
    most = held.groupBy("style", "_b").agg(F.min("from").alias("from")).select("style", "_b", up("from")).groupBy("style", "level").agg(F.max("_b").alias("_most"))
    changers, turns, denial = F.col("game_changers"), F.col("extra_turns"), F.col("mass_land_denials")
    rules = [F.when(changers > LIMITS["game_changer"][3], 4).when(changers > 0, 3), F.when(denial > 0, 4), F.when(turns > LIMITS["extra_turn"][2], 4).when(turns > 0, 2), F.col("_most")]
    return counts.join(most, ["style", "level"], "left").select("style", "level", *(f"{f}s" for f in FLAGS), F.greatest(F.lit(1), *(F.coalesce(r, F.lit(1)) for r in rules)).alias("bracket"))
