"""Ordered classifiers: the first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def first_match(x: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first pattern found in x."""
    out = F.lit(otherwise)
    for pattern, label in reversed(rules):
        out = F.when(x.rlike(pattern), label).otherwise(out)
    return out


def place(finish: Column) -> Column:
    """The place of a finish: an ordinal's number, 'Top N' as N / 2 + 1, null for anything else."""
    ordinal = F.regexp_extract(finish, r"^(\d+)(?:st|nd|rd|th)$", 1).try_cast("int")
    top = F.regexp_extract(finish, r"^Top (\d+)$", 1).try_cast("int")
    return F.coalesce(ordinal, (F.floor(top / 2) + 1).cast("int"))


def bucket(place: Column) -> Column:
    """Top 4, 8, 16 or 32 for a place beyond the third, an ordinal up to it."""
    return F.when(place <= 3, ordinal(place)).when(place <= 4, "Top 4").when(place <= 8, "Top 8").when(place <= 16, "Top 16").when(place <= 32, "Top 32")


def ordinal(n: Column) -> Column:
    teen = (n % 100).between(11, 13)
    return F.concat(n.cast("string"), F.when(~teen & (n % 10 == 1), "st").when(~teen & (n % 10 == 2), "nd").when(~teen & (n % 10 == 3), "rd").otherwise("th"))


def listed_first(x: Column, order: list[str], otherwise: str = "Other") -> Column:
    """The first value of order that array x holds."""
    out = F.lit(otherwise)
    for v in reversed(order):
        out = F.when(F.array_contains(x, v), v).otherwise(out)
    return out
