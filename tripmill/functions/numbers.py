"""Rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(x: Column, digits: int) -> Column:
    """Round half away from zero on ten exact decimals.

    The detour over a decimal removes the last-bit noise a floating-point sum
    carries, so the result does not depend on the order of addition. Values a
    decimal cannot hold (huge, NaN, infinite) are rounded as doubles.
    """
    x = x.cast("double")
    exact = F.round(x.try_cast("decimal(28,10)"), digits).cast("double")
    return F.coalesce(exact, F.round(x, digits))


# Below this size, and this far from a half, a double cannot be rounded otherwise than its ten decimals.
_PLAIN_LIMIT, _HALF_ERROR = 1e6, 1e-5


def round_rows(x: Column, digits: int) -> Column:
    """``round_to`` for a measure of every row: the same values for less.

    A decimal is made from the double's text. Only values near a half, where ten decimals decide, and large
    ones need it.
    """
    x = x.cast("double")
    scaled = x * F.lit(10.0**digits)
    plain = (F.abs(x) < _PLAIN_LIMIT) & (F.abs(scaled - F.floor(scaled) - 0.5) > _HALF_ERROR)
    # A zero added to a negative zero gives a plain one, as a decimal does.
    return F.when(plain, (F.rint(scaled) + 0.0) / F.lit(10.0**digits)).otherwise(round_to(x, digits))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division giving NULL instead of an error for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def average(total: str, count: str) -> Column:
    """Mean over rows that carry a partial sum and a count of non-NULL values."""
    return ratio(F.sum(total), F.sum(count))
