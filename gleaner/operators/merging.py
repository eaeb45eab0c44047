"""Which archetypes are published as one: leaders that stay from run to run, members that stick, and hand-kept rules."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner.operators import rounds
from gleaner.operators.bounds import MOST
from gleaner.operators.rounds import large_groups
from gleaner.operators.similarity import profile_cosine
from gleaner.session import ship, written

#: A new member's score, a staying member's score, and how far a member must outgrow its leader to lead.
THRESHOLD, STICKY, MARGIN = 0.8, 0.75, 1.2


class Plan:
    """The pass over one group's archetypes, biggest first. All relations are plain dicts and sets."""

    def __init__(self, order: list, decks: dict, scores: dict, apart: set, always: list[set]):
        self.order, self.decks, self.scores, self.apart, self.always = order, decks, scores, apart, always
        self.rank = {x: i for i, x in enumerate(order)}
        self.leader: dict = {}
        self.members: dict = {}
        self.how: dict = {}

    def score(self, x, y) -> tuple[float, int]:
        return self.scores.get((x, y), (0.0, 0))

    def put(self, x, leader, how: str) -> None:
        self.leader[x], self.how[x] = leader, how
        self.members.setdefault(leader, []).append(x)

    def fits(self, x, leader) -> bool:
        return all((x, y) not in self.apart for y in self.members[leader])

    def standing(self, previous: dict) -> dict:
        """Opens the last run's groups that still have their leader and another member; who is to stay with whom."""
        stay: dict = {}
        for was in sorted((x for x in self.order if x in set(previous.values())), key=self.rank.get):
            there = [x for x in self.order if previous.get(x) == was and x != was]
            if there:
                leads = there[0] if self.decks[there[0]] > MARGIN * self.decks[was] else was
                self.put(leads, leads, "leads")
                stay |= {x: leads for x in [was, *there] if x != leads}
        return stay

    def wanted(self, x) -> list:
        """The groups of those that a rule always puts with x, biggest first."""
        others = [y for ids in self.always if x in ids for y in sorted(ids - {x}, key=lambda y: self.rank.get(y, len(self.order)))]
        return [self.leader[y] for y in others if y in self.leader]

    def run(self, previous: dict) -> None:
        stay = self.standing(previous)
        for x in self.order:
            if x in self.leader:
                continue
            forced = next((y for y in self.wanted(x) if self.fits(x, y)), None)
            if forced is not None:
                self.put(x, forced, "forced")
                continue
            old = stay.get(x)
            if old in self.members and self.fits(x, old) and self.score(x, old)[0] >= STICKY:
                self.put(x, old, "joined" if self.score(x, old)[0] >= THRESHOLD else "kept")
                continue
            near = [(self.score(x, y)[0], -self.rank[y], y) for y in self.members if self.fits(x, y)]
            best = max(near, default=(0.0, 0, None))
            self.put(x, best[2] if best[0] >= THRESHOLD else x, "joined" if best[0] >= THRESHOLD else "leads")


def _in_rounds(sizes: DataFrame, scores: DataFrame, previous: DataFrame, apart: DataFrame, always: DataFrame) -> DataFrame:
    """The plan without a task per group: group, id, leader, how."""
    key = F.struct("decks", "id")
    items = sizes.select("group", "id", "decks", key.alias("big"))
    of = lambda c: items.select("group", F.col("id").alias(c), F.col("decks").alias(f"n_{c}"), F.col("big").alias(f"big_{c}"))
    was = previous.where("id <> leader").join(of("id"), ["group", "id"]).join(of("leader"), ["group", "leader"])
    first = was.groupBy("group", "leader").agg(F.max_by(F.struct("id", "n_id"), "big_id").alias("_m"), F.first("n_leader").alias("n_leader"), F.first("big_leader").alias("big_leader"))
    first = first.select("group", F.col("leader").alias("was"), "big_leader", F.when(F.get("_m.n_id", F.lit(0)) > MARGIN * F.get("n_leader", F.lit(0)), F.col("_m.id")).otherwise(F.col("leader")).alias("leads"))
    stays = was.select("group", F.col("leader").alias("was"), "id").union(first.select("group", "was", F.col("was").alias("id"))).join(first, ["group", "was"]).where("id <> leads")
    stays = stays.groupBy("group", "id").agg(F.min_by("leads", "big_leader").alias("y"))
    standing = first.select("group", F.col("leads").alias("id")).distinct().withColumn("leads", F.lit(True))
    items = written(items.join(standing, ["group", "id"], "left").withColumn("leads", F.coalesce("leads", F.lit(False))))
    item = lambda c: items.select("group", F.col("id").alias(c), F.col("big").alias(f"b{c}"), F.col("leads").alias(f"l{c}"))
    both = lambda df: df.select("group", F.col("a").alias("x"), F.col("b").alias("y"), *df.columns[3:]).unionByName(df.select("group", F.col("b").alias("x"), F.col("a").alias("y"), *df.columns[3:]))

    pairs = both(scores.select("group", "a", "b", "score").groupBy("group", "a", "b").agg(F.max("score").alias("score")))
    edge = lambda df, kind, rule=F.lit(""), score=F.lit(None).cast("double"): df.select("group", "x", "y", F.lit(kind).alias("kind"), rule.alias("rule"), score.alias("score"))
    near = edge(pairs.where(F.col("score") >= THRESHOLD), "near", score=F.col("score"))
    stay = edge(stays.withColumnRenamed("id", "x").join(pairs, ["group", "x", "y"]), "stay", score=F.col("score"))
    foes = edge(both(apart.select("group", "a", "b")).distinct(), "apart")
    same = always.select("group", "rule", F.col("id").alias("x")).join(always.select("group", "rule", F.col("id").alias("y")), ["group", "rule"]).where("x <> y").distinct()
    edges = near.unionByName(stay).unionByName(foes).unionByName(edge(same, "always", rule=F.col("rule")))
    edges = edges.join(item("x"), ["group", "x"]).join(item("y"), ["group", "y"]).where(~F.col("lx") & (F.col("ly") | (F.col("by") > F.col("bx"))))
    return rounds.leaders(items.select("group", "id", "leads"), written(edges.select("group", "x", "y", "kind", "rule", "score", F.col("by").alias("big"))), THRESHOLD, STICKY)


def planned(sizes: DataFrame, scores: DataFrame, previous: DataFrame, apart: DataFrame, always: DataFrame, disabled: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """Per archetype: group, id, leader, score and days of the window it comes from, and how (leads, joined, kept, forced).

    sizes: group, id, decks (longest window first, then its lists if they are to break ties; array<long>); scores: group, a, b, score, days for unordered pairs, the
    best of all windows (best_scores); previous: group, id, leader; apart: group, a, b; always: group, rule, id; disabled: groups that are published unmerged.

    A group's leader of the last run stays unless a member has more than MARGIN times its decks; its members stay at STICKY.
    Others join the leader they score highest against at THRESHOLD, ties to the bigger, or lead. Groups of up to `most` scored pairs are a task
    each; in larger ones an archetype waits only for the bigger ones that it is scored, kept apart or put together with, and they are
    settled in rounds, with the same result. Null scores don't count.
    """
    scores = scores.where("score is not null")
    if disabled is not None:
        alone = sizes.join(disabled.select("group").distinct(), "group", "left_semi")
        rest = lambda df: df.join(disabled.select("group").distinct(), "group", "left_anti")
        made = planned(rest(sizes), scores, previous, apart, always, most=most)
        return made.unionByName(alone.select(F.col("group").cast("string").alias("group"), F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("leader"), F.lit(1.0).alias("score"), F.lit(0).alias("days"), F.lit("leads").alias("how")))
    empty = {"x": "string", "y": "string", "n": "array<bigint>", "s": "double", "k": "int"}

    def rows(df: DataFrame, kind: str, **columns) -> DataFrame:
        return df.select("group", F.lit(kind).alias("kind"), *(columns[c].cast(t).alias(c) if c in columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        of = {k: g for k, g in pdf.groupby("kind")}
        pairs = lambda k: list(zip(of[k]["x"], of[k]["y"])) if k in of else []
        decks = {x: list(n) for x, n in zip(of["size"]["x"], of["size"]["n"])} if "size" in of else {}
        best = {p: (s, int(k)) for p, s, k in zip(pairs("score"), of["score"]["s"], of["score"]["k"])} if "score" in of else {}
        rules: dict = {}
        for x, rule in pairs("always"):
            rules.setdefault(rule, set()).add(x)
        p = Plan(
            sorted(decks, key=lambda x: (decks[x], x), reverse=True), {x: n[0] for x, n in decks.items()}, best | {(y, x): v for (x, y), v in best.items()},
            {q for x, y in pairs("apart") for q in ((x, y), (y, x))}, [rules[r] for r in sorted(rules)],
        )
        p.run({x: y for x, y in pairs("was") if x in decks})
        got = [(pdf["group"].iloc[0], x, y, *(p.score(x, y) if x != y else (1.0, 0)), p.how[x]) for x, y in p.leader.items()]
        return pd.DataFrame(got, columns=["group", "id", "leader", "score", "days", "how"])

    ship(sizes.sparkSession)
    large = large_groups(scores, "group", most)
    few = lambda df: df if large is None else df.join(large, "group", "left_anti")
    c = F.col
    everything = rows(few(sizes), "size", x=c("id"), n=c("decks"))
    for part in (
        rows(few(scores), "score", x=c("a"), y=c("b"), s=c("score"), k=c("days")),
        rows(few(previous), "was", x=c("id"), y=c("leader")),
        rows(few(apart), "apart", x=c("a"), y=c("b")),
        rows(few(always), "always", x=c("id"), y=c("rule")),
    ):
        everything = everything.union(part)
    made = everything.groupBy("group").applyInPandas(settle, "group string, id string, leader string, score double, days int, how string")
    if large is None:
        return made
    many = lambda df: df.join(large, "group", "left_semi")
    wide = _in_rounds(*(written(many(df)) for df in (sizes, scores, previous, apart, always)))
    best = scores.select("group", F.col("a").alias("id"), F.col("b").alias("leader"), "score", "days").unionByName(scores.select("group", F.col("b").alias("id"), F.col("a").alias("leader"), "score", "days"))
    wide = wide.join(best, ["group", "id", "leader"], "left")
    alone = F.col("id") == F.col("leader")
    return made.unionByName(wide.select(F.col("group").cast("string").alias("group"), "id", "leader", F.when(alone, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"), F.when(alone, 0).otherwise(F.coalesce("days", F.lit(0))).alias("days"), "how"))


def assigned(plan: DataFrame, sizes: DataFrame, profiles: DataFrame, results: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The leader that each result without an archetype joins: group, item, leader, score.

    profiles: group, id, slug, w: the lists of the longest window; results: group, item, slug, w. A result joins the leader whose
    own list it scores highest against, at threshold or more, ties to the bigger; others and those without a list have no row. Results dealt by
    item stay where they are (see similarity.profile_cosine).
    """
    lead = plan.where("id = leader").select("group", "id").join(sizes.select("group", "id", "decks"), ["group", "id"])
    of = profiles.join(lead, ["group", "id"]).select("group", "slug", "w", F.struct("group", "decks", "id").alias("_l"))
    scores = profile_cosine(results, of, ["group", "item"], "_l", ["group", "slug"])
    x = scores.select("group", "item", "_l", F.round("cosine", 12).alias("score")).where(F.col("score") >= threshold)
    best = F.max_by(F.struct(F.col("_l.id").alias("leader"), "score"), F.struct("score", "_l.decks", "_l.id"))
    return x.groupBy("group", "item").agg(best.alias("_b")).select("group", "item", "_b.leader", "_b.score")


def best_scores(scores: DataFrame) -> DataFrame:
    """The best score of each pair over the windows, the shorter window's of equals: group, a, b, score, days."""
    return scores.groupBy("group", "a", "b").agg(F.max_by(F.struct("score", "days"), F.struct("score", -F.col("days"))).alias("x")).select("group", "a", "b", "x.*")


def report(plan: DataFrame, scores: DataFrame, unassigned: DataFrame, floor: float) -> DataFrame:
    """A dry run per group: pairs above the floor, groups of several archetypes, archetypes merged away, and decks left over."""
    high = scores.where(F.col("score") >= floor).groupBy("group").agg(F.count(F.lit(1)).alias("pairs"))
    of = plan.groupBy("group", "leader").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(F.count_if(F.col("n") > 1).alias("groups"), F.sum(F.col("n") - 1).alias("merged"))
    left = unassigned.groupBy("group").agg(F.count(F.lit(1)).alias("left"))
    return of.join(high, "group", "left").join(left, "group", "left").na.fill(0, ["pairs", "left"])
