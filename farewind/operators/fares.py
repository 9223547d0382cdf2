"""Browsing fares and quotes."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from farewind.operators.filters import ALL, where_equal


def fares_for(
    fares: DataFrame, destination: Any = ALL, source: Any = ALL, airline: Any = ALL
) -> DataFrame:
    """Fares of a destination, source or airline."""
    return where_equal(fares, Destination=destination, Source=source, Airline=airline)


def quotes_for(quotes: DataFrame, source: Any = ALL, destination: Any = ALL) -> DataFrame:
    """Quotes of one connection."""
    return where_equal(quotes, source=source, destination=destination)


def cheapest_fares(fares: DataFrame, destination: str | None = None, limit: int = 20) -> DataFrame:
    """The cheapest offers to a destination as (Airline, Source, Price).

    Without a destination there is nothing to compare: any ``limit`` rows, all columns.
    """
    if not destination:
        return fares.limit(limit)
    offers = fares_for(fares, destination).select("Airline", "Source", "Price")
    return offers.orderBy("Price", "Airline", "Source").limit(limit)
