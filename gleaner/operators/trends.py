"""Comparisons of a recent period with the one before."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gleaner.functions import numbers


def proportion_trend(hits: Column, n: Column, hits_before: Column, n_before: Column, points: int = 5, z: float = 3.0) -> Column:
    """up or down if the shares differ by more than points (in exact integers) and |z| > z; null if a period is empty."""
    gap = 100 * (hits * n_before - hits_before * n)
    clear = (F.abs(gap) > points * n * n_before) & (F.abs(numbers.pooled_z(hits, n, hits_before, n_before)) > z)
    return F.when((n > 0) & (n_before > 0), F.when(clear, F.when(gap > 0, "up").otherwise("down")).otherwise("steady"))


def tenths_trend(now: Column, before: Column, tenths: int = 10) -> Column:
    """up or down if shares in tenths differ by more than tenths."""
    gap = F.round(now * 10) - F.round(before * 10)
    return F.when(gap > tenths, "up").when(gap < -tenths, "down").otherwise("steady")


def breakout(decks: Column, of_decks: Column, before: Column, of_before: Column, least: int = 4, percent: int = 1, times: int | Column = 3) -> Column:
    """At least so many decks and percent of the recent ones, and times the share of the baseline."""
    return (decks >= least) & (100 * decks >= percent * of_decks) & (decks * of_before >= times * before * of_decks)
