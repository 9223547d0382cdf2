"""Durations, price bands and ratings of a fare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farewind.functions._columns import as_column

# The marks of hours and minutes in a duration text.
HOURS_PATTERN = "([0-9]+)h"
MINUTES_PATTERN = "([0-9]+)m"


def duration_minutes(text: Column | str) -> Column:
    """``"2h 30m"`` to 150.

    A missing part counts as 0; without either part, or past the range of int, the result
    is null.
    """
    hours = F.regexp_extract(as_column(text), HOURS_PATTERN, 1)
    minutes = F.regexp_extract(as_column(text), MINUTES_PATTERN, 1)
    total = F.try_add(F.try_multiply(_count(hours), F.lit(60)), _count(minutes))
    return F.when((hours != "") | (minutes != ""), total.try_cast("int"))


def _count(digits: Column) -> Column:
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("bigint"))


# Fixed value: the width of a band.
BAND_WIDTH = 500


def price_band(price: Column | str, width: int = BAND_WIDTH) -> Column:
    """``"lo~hi"`` of the band of ``width`` that holds the price; bands start at multiples."""
    whole = as_column(price).cast("bigint")
    low = whole - F.pmod(whole, F.lit(width))
    return F.concat(low.cast("string"), F.lit("~"), (low + width).cast("string"))


def rating_delay(
    price: Column | str, minutes: Column | str, delay: Column | str, airline: Column | str
) -> Column:
    """Rating that weighs delay first, then price, duration and airline.

    ``delay`` may be text, as events carry it; ``airline`` is the index of its label.
    """
    # fixed values: the weights
    rating = (
        0.3 * as_column(delay).try_cast("double")
        + 0.5 * _inverse(price)
        + 0.1 * _inverse(minutes)
        + 0.1 * as_column(airline).cast("double")
    )
    return rating.cast("float")


def rating_preference(
    price: Column | str, minutes: Column | str, preference: Column | str
) -> Column:
    """Rating that weighs the preference for an airline first, then price and duration."""
    # fixed values: the weights
    rating = (
        0.7 * as_column(preference).cast("double")
        + 0.2 * _inverse(price)
        + 0.1 * _inverse(minutes)
    )
    return rating.cast("float")


def _inverse(value: Column | str) -> Column:
    """1 / (value + 1); null at -1."""
    return F.try_divide(F.lit(1.0), as_column(value).cast("double") + 1.0)
