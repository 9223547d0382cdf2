"""Literal rows used by several tests."""

from __future__ import annotations

from decimal import Decimal

# Five fares, in the order of the columns of FARE.
FARE_ROWS = [
    (
        "CheeseAir", "2023-09-01", "Delhi", "Mumbai", "DEL -> BOM",
        "10:00", "12:00", "2h", "non-stop", "No info", 1,
    ),
    (
        "CheeseAir", "2023-09-02", "Mumbai", "Delhi", "BOM -> DEL",
        "14:00", "16:30", "2h 30m", "non-stop", "No info", 21,
    ),
    (
        "CheeseAir", "2023-09-03", "Bangalore", "Kolkata", "BLR -> CCU",
        "06:00", "08:30", "2h 30m", "non-stop", "No info", 42,
    ),
    (
        "CheeseAir", "2023-09-04", "Chennai", "Hyderabad", "MAA -> HYD",
        "09:00", "10:30", "1h 30m", "non-stop", "No info", 1337,
    ),
    (
        "CheeseAir", "2023-09-05", "Pune", "Delhi", "PNQ -> DEL",
        "18:00", "20:30", "2h 30m", "non-stop", "No info", 17,
    ),
]

# Departure, source, destination and price of 24 quotes.
QUOTE_ROWS = [
    ("2024-09-19T12:00:00", "SEA", "TYO", Decimal("123.45")),
    ("2024-09-20T08:00:00", "LAX", "LHR", Decimal("456.78")),
    ("2024-09-21T09:30:00", "NYC", "PAR", Decimal("789.01")),
    ("2024-09-22T07:45:00", "SFO", "BER", Decimal("234.56")),
    ("2024-09-23T10:15:00", "MIA", "MAD", Decimal("567.89")),
    ("2024-09-24T11:00:00", "CHI", "ROM", Decimal("890.12")),
    ("2024-09-25T05:30:00", "SEA", "DEL", Decimal("345.67")),
    ("2024-09-26T06:45:00", "LAX", "SYD", Decimal("678.90")),
    ("2024-09-28T04:00:00", "SFO", "BKK", Decimal("123.34")),
    ("2024-09-29T03:00:00", "SEA", "LAX", Decimal("234.56")),
    ("2024-09-30T02:15:00", "SEA", "NYC", Decimal("345.67")),
    ("2024-10-01T01:30:00", "SEA", "SFO", Decimal("456.78")),
    ("2024-10-02T05:45:00", "SEA", "MIA", Decimal("567.89")),
    ("2024-10-03T06:00:00", "SEA", "CHI", Decimal("678.90")),
    ("2024-10-04T07:15:00", "LAX", "NYC", Decimal("789.01")),
    ("2024-10-05T08:30:00", "LAX", "SFO", Decimal("890.12")),
    ("2024-10-06T09:45:00", "LAX", "MIA", Decimal("901.23")),
    ("2024-10-07T10:00:00", "LAX", "CHI", Decimal("123.45")),
    ("2024-10-08T11:15:00", "NYC", "SFO", Decimal("234.56")),
    ("2024-10-09T12:30:00", "NYC", "MIA", Decimal("345.67")),
    ("2024-10-10T13:45:00", "NYC", "CHI", Decimal("456.78")),
    ("2024-10-11T14:00:00", "SFO", "MIA", Decimal("567.89")),
    ("2024-10-12T15:15:00", "SFO", "CHI", Decimal("678.90")),
    ("2024-10-13T16:30:00", "MIA", "CHI", Decimal("789.01")),
]
