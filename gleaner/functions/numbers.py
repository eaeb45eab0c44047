"""Numbers: rounding as Python does, ratios and apportionment helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def half_even(digits: int) -> Callable[[Column], Column]:
    """Rounding of doubles on their exact binary value, ties to even; built-in round() works on the decimal text.

    The product with the power of ten is taken with its rounding error (both factors split in halves of 26 bits), so that
    a value just beside a tie is seen to be beside it.
    """
    scale, splitter = 10.0**digits, 134217729.0

    def parts(v: Column) -> tuple[Column, Column]:
        high = v * splitter - (v * splitter - v)
        return high, v - high

    def rounded(x: Column) -> Column:
        (a, b), (c, d), product = parts(x), parts(F.lit(scale)), x * scale
        error = ((a * c - product) + a * d + b * c) + b * d
        low = F.floor(product).cast("double")
        beside = (product - low - 0.5) + error
        even = F.when(F.pmod(low, F.lit(2.0)) == 0, low).otherwise(low + 1)
        whole = F.when(beside > 0, low + 1).when(beside < 0, low).otherwise(even)
        return F.when(F.abs(product) < 2.0**51, whole / scale).otherwise(x)

    return rounded


def share(part: Column, whole: Column) -> Column:
    """Percent with one digit."""
    return F.round(part * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), 1)


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def significant(x: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}g", x).cast("double")


def pooled_z(hits_a: Column, n_a: Column, hits_b: Column, n_b: Column) -> Column:
    """z of the difference of two proportions with pooled variance; null where either period or the variance is empty."""
    p = (hits_a + hits_b) / F.nullif((n_a + n_b).cast("double"), F.lit(0.0))
    spread = F.sqrt(p * (1 - p) * (F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b)))
    return F.try_divide(F.try_divide(hits_a, n_a) - F.try_divide(hits_b, n_b), F.nullif(spread, F.lit(0.0)))


def linear(channel: Column) -> Column:
    """An sRGB channel of 0 to 1 as linear light."""
    return F.when(channel <= 0.04045, channel / 12.92).otherwise(F.pow((channel + 0.055) / 1.055, F.lit(2.4)))


def gamma(light: Column) -> Column:
    return F.when(light <= 0.0031308, light * 12.92).otherwise(1.055 * F.pow(light, F.lit(1 / 2.4)) - 0.055)


