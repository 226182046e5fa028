"""Scalar and windowed column expressions (all JVM-side, ANSI-safe)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_ratio(price: Column, previous: Column) -> Column:
    """ln(price / previous); NULL without a positive previous price."""
    return F.when(previous > 0, F.log(price / previous))


def rsi(gain: Column, loss: Column) -> Column:
    """Relative strength from the mean gain and mean loss; 100 without any loss."""
    return F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + gain / loss))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def valid_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def monday_week(day: Column) -> Column:
    """Week of the year, weeks starting on Monday; 0 before the first Monday."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


# Price bands of the instrument dimension (upper bound, name), then the rest.
PRICE_BANDS: tuple[tuple[float, str], ...] = ((5, "microcap"), (20, "smallcap"))
TOP_PRICE_BAND = "midcap_plus"


def price_band(
    price: Column,
    bands: Sequence[tuple[float, str]] = PRICE_BANDS,
    top: str = TOP_PRICE_BAND,
) -> Column:
    """Name of the first band whose upper bound lies above the price."""
    named = None
    for upper, name in bands:
        named = (F if named is None else named).when(price < upper, F.lit(name))
    return F.lit(top) if named is None else named.otherwise(top)
