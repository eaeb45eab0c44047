"""Guides: inclusion scores, lift, levels, candidate pools, constrained fill."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.operators.priority import first_per_key


def inclusion(page_cards: DataFrame) -> DataFrame:
    """rate: decks of a page that play the card, as a share of the page's decks."""
    return page_cards.withColumn("rate", F.coalesce(F.try_divide(F.col("decks"), F.col("of_decks")), F.lit(0.0)))


def blended(themed: Column, base: Column, bracket: Column) -> Column:
    """max(0, themed rate (the base page's where the theme has none) plus what the bracket adds to the base)."""
    return F.greatest(F.lit(0.0), F.coalesce(themed, base, F.lit(0.0)) + F.coalesce(bracket - base, F.lit(0.0)))


def lifted(rates: DataFrame, groups: int, card: str, least_lift: float, least_rate: float) -> DataFrame:
    """Cards whose rate exceeds the mean rate of the other groups (of groups in all) by least_lift; a group without the
    card counts as 0."""
    others = F.greatest(F.lit(groups - 1), F.lit(1))
    total = rates.groupBy(card).agg(F.sum("rate").alias("_sum"))
    lift = F.col("rate") - (F.col("_sum") - F.col("rate")) / others
    return rates.join(total, card).withColumn("lift", lift).where((F.col("lift") >= least_lift) & (F.col("rate") >= least_rate)).drop("_sum")


def levels(split: DataFrame, key: str, level: str, decks: str, least_percent: int = 10) -> DataFrame:
    """Per key: the levels with at least so many percent of its decks, filled to a range without gaps, and the most
    played one (the lower of equals)."""
    w = Window.partitionBy(key)
    x = split.withColumn("_t", F.sum(decks).over(w))
    kept = F.when(100 * F.col(decks) >= least_percent * F.col("_t"), F.col(level))
    out = x.groupBy(key).agg(F.min(kept).alias("_lo"), F.max(kept).alias("_hi"), F.max_by(level, F.struct(decks, -F.col(level))).alias("most_played"))
    return out.where("_lo is not null").select(key, F.explode(F.sequence("_lo", "_hi")).alias(level), "most_played")


def nearest_level(wanted: DataFrame, have: DataFrame, key: str, level: str, found: str) -> DataFrame:
    """For each wanted level the nearest one of the key with data; the higher of two."""
    pairs = wanted.join(have.withColumnRenamed(level, found), key)
    return first_per_key(pairs.select(key, level, found), [key, level], [F.abs(F.col(level) - F.col(found)), -F.col(found)])


def playable(cards: DataFrame, colors: str, identity: Column) -> DataFrame:
    """Cards whose colours all lie within the identity; cards of unknown colours don't."""
    return cards.where(F.col(colors).isNotNull() & (F.size(F.array_except(F.col(colors), identity)) == 0))


def pool(rates: DataFrame, key: str, card: str, k: int) -> DataFrame:
    """Per key: the k cards with the best rate on any page, ties by name."""
    best = rates.groupBy(key, card).agg(F.max("rate").alias("best"))
    return best.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("best"), card))).where(F.col("_r") <= k).drop("_r")


def resolved(rates: DataFrame, known: DataFrame, commanders: DataFrame, key: str, card: str) -> DataFrame:
    """Per key each card once, under its name in the catalog (known: card, name), with the best of its rates. Cards that the
    catalog lacks, and commanders of the key (key, name), are left out."""
    named = rates.join(known.select(card, "name"), card).join(commanders.select(key, "name"), [key, "name"], "left_anti")
    return named.groupBy(key, "name").agg(F.max("rate").alias("rate"))


def fill(candidates: DataFrame, group: str, card: str, role: str, score: str, aims: dict[str, int], slots: int, limits: dict[str, int], flag: str, combos: dict[str, set[str]] | None = None) -> DataFrame:
    """Greedy constrained fill per group: by score (ties by name), first up to each role's aim, then from any role up to
    slots. A card whose flag has reached its limit, or that would complete a forbidden combination, is passed over.

    Each choice depends on those before it, so a group is one task; its candidates are a pool (see pool), bounded by its k.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values([score, card], ascending=[False, True])
        chosen, names, by_role, by_flag = [], set(), {}, {}

        def allowed(name, f) -> bool:
            full = pd.notna(f) and by_flag.get(f, 0) >= limits.get(f, slots)
            return not full and not any(name in c and c <= names | {name} for c in (combos or {}).values())

        for any_role in (False, True):
            for row in ordered.itertuples(index=False):
                name, r, f = getattr(row, card), getattr(row, role), getattr(row, flag)
                if len(chosen) >= slots or name in names or not any_role and by_role.get(r, 0) >= aims.get(r, 0) or not allowed(name, f):
                    continue
                names.add(name)
                by_role[r] = by_role.get(r, 0) + 1
                by_flag[f] = by_flag.get(f, 0) + 1
                chosen.append((getattr(row, group), len(chosen) + 1, name, r))
        return pd.DataFrame(chosen, columns=[group, "pick", card, role])

    kinds = dict(candidates.dtypes)
    return candidates.groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, pick int, {card} {kinds[card]}, {role} {kinds[role]}")
