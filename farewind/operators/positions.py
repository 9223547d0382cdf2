"""Aircraft state vectors: counts, latest positions, tracks and paths."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farewind.functions import epoch_text
from farewind.operators.filters import ALL, where_equal
from farewind.operators.ordering import MAX_GROUP_ROWS, with_next

# The columns shown of a position and of a point of a track.
POSITION_COLUMNS = (
    "icao24", "callsign", "origin_country", "longitude", "latitude", "baro_altitude", "velocity",
)
TRACK_COLUMNS = (
    "icao24", "callsign", "origin_country", "time_position", "longitude", "latitude",
    "baro_altitude", "velocity", "last_contact",
)
# Columns that settle the order of points with equal contact time.
TRACK_TIES = ("icao24", "time_position", "longitude", "latitude", "baro_altitude", "velocity")


def top_callsigns(states: DataFrame, k: int = 50, label_nulls: bool = False) -> DataFrame:
    """The ``k`` callsigns with most entries; rows without a callsign count as one group.

    ``label_nulls`` names that group ``None``.
    """
    counts = states.groupBy("callsign").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc("callsign")).limit(k)
    if label_nulls:
        top = top.withColumn("callsign", F.coalesce("callsign", F.lit("None")))
    return top


def last_contact_by_position(
    states: DataFrame, country: Any = ALL, ordered: bool = True
) -> DataFrame:
    """Last contact of every aircraft at every position it reported, latest first.

    The order is for display; ``ordered=False`` saves the sort of the whole result.
    """
    seen = where_equal(states, origin_country=country)
    latest = seen.groupBy(*POSITION_COLUMNS).agg(F.max("last_contact").alias("last_contact"))
    return latest.orderBy(F.desc("last_contact"), *POSITION_COLUMNS) if ordered else latest


def latest_positions(
    states: DataFrame, country: Any = ALL, ties: Sequence[str] = TRACK_TIES
) -> DataFrame:
    """Where each aircraft was at its last contact, one row per aircraft."""
    seen = where_equal(states, origin_country=country).filter(F.col("last_contact").isNotNull())
    kept = [name for name in (*POSITION_COLUMNS, "last_contact") if name != "icao24"]
    newest = F.max_by(F.struct(*kept), F.struct("last_contact", *ties)).alias("at")
    return seen.groupBy("icao24").agg(newest).select("icao24", "at.*")


def flight_track(
    states: DataFrame,
    country: Any = ALL,
    callsign: Any = ALL,
    ties: Sequence[str] = TRACK_TIES,
    ordered: bool = True,
) -> DataFrame:
    """All reported points of a flight, latest first unless ``ordered`` is false."""
    seen = where_equal(states, origin_country=country, callsign=callsign)
    if ordered:
        seen = seen.orderBy(F.desc("last_contact"), *[F.desc(name) for name in ties])
    return seen.select(*TRACK_COLUMNS)


def path_segments(
    states: DataFrame,
    country: Any = ALL,
    callsign: Any = ALL,
    per_aircraft: bool = False,
    ties: Sequence[str] = TRACK_TIES,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Lines between neighbouring points of a flight, latest first: n points give n-1 lines.

    Points without time or place are left out before neighbours are found. A flight is a
    (country, callsign) pair, or an aircraft with ``per_aircraft``. ``time_utc`` is the time
    of the point a line starts from. Counts the points of every flight when called.
    """
    group = ["icao24"] if per_aircraft else ["origin_country", "callsign"]
    needed = dict.fromkeys(
        [*group, "time_position", "last_contact", "longitude", "latitude", *ties]
    )
    points = (
        where_equal(states, origin_country=country, callsign=callsign)
        .na.drop(subset=["time_position", "longitude", "latitude"])
        .select(*needed)
    )
    order = [F.desc("last_contact"), *[F.desc(name) for name in ties]]
    lines = with_next(points, group, order, ["longitude", "latitude"], max_group_rows)
    return lines.filter("has_next").select(
        *group,
        "last_contact",
        "longitude",
        "latitude",
        "next_longitude",
        "next_latitude",
        epoch_text("time_position").alias("time_utc"),
    )
