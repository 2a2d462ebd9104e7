"""Canonical values and text of a trip's business key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.contracts import BUSINESS_KEY

_DECIMALS = {"trip_distance_miles", "fare_amount", "total_amount"}


# Amounts below this many units are compared as whole steps of a ten-thousandth if they lie that close to one.
_GRID, _GRID_LIMIT, _GRID_ERROR = 10_000, 10_000, 1e-7


def _amount_values(name: str) -> list[Column]:
    """An amount to ten decimals, as columns that are equal for equal decimals.

    A decimal of a double goes through its text, which is slow for every trip. An amount within 1e-11
    of a ten-thousandth is that ten-thousandth to ten decimals, so its number of steps stands for it.
    Others become decimals, and those that are a whole number of steps again get that number. A value that a decimal
    cannot hold is compared as it is.
    """
    col = F.col(name)
    steps = col * F.lit(float(_GRID))
    near = (F.abs(col) < float(_GRID_LIMIT)) & (F.abs(steps - F.rint(steps)) < _GRID_ERROR)
    fixed = col.try_cast("decimal(28,10)")
    on_grid = (F.abs(fixed) <= _GRID_LIMIT) & (fixed == F.round(fixed, 4))
    whole = F.when(near, F.rint(steps).try_cast("bigint")).when(on_grid, (fixed * _GRID).try_cast("bigint"))
    elsewhere = F.when(near | on_grid, None)
    return [whole, elsewhere.otherwise(fixed), elsewhere.when(fixed.isNull(), col)]


def key_values() -> list[Column]:
    """What copies have in common: amounts count to ten decimals, as in the hashed text."""
    values = []
    for name in BUSINESS_KEY:
        values += _amount_values(name) if name in _DECIMALS else [F.col(name)]
    return values


def _text(name: str) -> Column:
    col = F.col(name)
    if name in _DECIMALS:
        fixed = col.try_cast("decimal(28,10)").cast("string")
        return F.coalesce(fixed, col.cast("string"), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def trip_key() -> Column:
    """MD5 over the business key; amounts in a fixed number of decimals so that
    the text does not depend on how an engine prints doubles."""
    return F.md5(F.concat_ws("|", *[_text(name) for name in BUSINESS_KEY]))
