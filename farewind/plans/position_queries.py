"""Positions: counts, latest contacts, tracks and paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from farewind.functions import epoch_text, epoch_timestamp
from farewind.operators import positions
from farewind.operators.filters import distinct_values, run_sql
from farewind.plans.bindings import STATES_SQL, states

_TIES = ("event_id",)
_POSITION = ", ".join(positions.POSITION_COLUMNS)
_TRACK = ", ".join(positions.TRACK_COLUMNS)
_COUNTRY = "view"
_CALLSIGN = "C8"


def top_callsigns(spark, sf_dir):
    return positions.top_callsigns(states(spark, sf_dir))


def callsign_labels(spark, sf_dir):
    return positions.top_callsigns(states(spark, sf_dir), label_nulls=True)


def positions_last_contact(spark, sf_dir):
    return positions.last_contact_by_position(states(spark, sf_dir), ordered=False)


def positions_last_contact_country(spark, sf_dir):
    latest = positions.last_contact_by_position(states(spark, sf_dir), _COUNTRY)
    return latest.na.drop(subset=["last_contact"]).withColumn(
        "last_contact", epoch_text("last_contact", -8)
    )


def latest_positions(spark, sf_dir):
    return positions.latest_positions(states(spark, sf_dir), ties=_TIES)


def latest_positions_country(spark, sf_dir):
    return positions.latest_positions(states(spark, sf_dir), _COUNTRY, ties=_TIES)


def flight_track(spark, sf_dir):
    return positions.flight_track(states(spark, sf_dir), _COUNTRY, _CALLSIGN, ties=_TIES)


def path_segments(spark, sf_dir):
    return positions.path_segments(states(spark, sf_dir), ties=_TIES)


def path_segments_flight(spark, sf_dir):
    return positions.path_segments(states(spark, sf_dir), _COUNTRY, _CALLSIGN, ties=_TIES)


def path_segments_aircraft(spark, sf_dir):
    return positions.path_segments(states(spark, sf_dir), per_aircraft=True, ties=_TIES)


def path_segments_sliced(spark, sf_dir):
    """The same lines with a bound so low that many flights are cut into slices."""
    return positions.path_segments(states(spark, sf_dir), ties=_TIES, max_group_rows=25)


def contact_time_text(spark, sf_dir):
    return states(spark, sf_dir).select(
        "event_id",
        epoch_text("last_contact").alias("contact_utc"),
        epoch_text("last_contact", -8).alias("contact_pst"),
    )


def epoch_to_timestamp(spark, sf_dir):
    return states(spark, sf_dir).select(
        "event_id", F.unix_micros(epoch_timestamp("last_contact")).alias("contact_micros")
    )


def distinct_countries(spark, sf_dir):
    return distinct_values(states(spark, sf_dir), "origin_country")


def run_sql_named(spark, sf_dir):
    text = f"SELECT {_TRACK} FROM {{states}} WHERE origin_country = :country AND velocity > :speed"
    tables = {"states": states(spark, sf_dir)}
    return run_sql(spark, text, tables, country=_COUNTRY, speed=10.0)


def _segments_sql(group: str, where: str = "true") -> str:
    return f"""
WITH {STATES_SQL}, points AS (
  SELECT * FROM states WHERE time_position IS NOT NULL AND longitude IS NOT NULL
    AND latitude IS NOT NULL AND {where}),
lines AS (
  SELECT *, lead(longitude) OVER w AS next_longitude, lead(latitude) OVER w AS next_latitude
  FROM points WINDOW w AS (PARTITION BY {group} ORDER BY last_contact DESC, event_id DESC))
SELECT {group}, last_contact, longitude, latitude, next_longitude, next_latitude,
  strftime(make_timestamp(time_position * 1000000), '%Y-%m-%d %H:%M:%S') AS time_utc
FROM lines WHERE next_longitude IS NOT NULL"""


def _latest_sql(where: str = "true") -> str:
    return f"""
WITH {STATES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY last_contact DESC, event_id DESC) AS rn
  FROM states WHERE {where})
SELECT {_POSITION}, last_contact FROM ranked WHERE rn = 1"""


def _callsigns_sql(label: str) -> str:
    return f"""
WITH {STATES_SQL}, top AS (
  SELECT callsign, count(*) AS count FROM states GROUP BY callsign
  ORDER BY count DESC, callsign NULLS FIRST LIMIT 50)
SELECT {label} AS callsign, count FROM top"""


_FLIGHT = f"origin_country = '{_COUNTRY}' AND callsign = '{_CALLSIGN}'"

QUERIES = {
    "top_callsigns": (top_callsigns, _callsigns_sql("callsign")),
    "callsign_labels": (callsign_labels, _callsigns_sql("coalesce(callsign, 'None')")),
    "positions_last_contact": (
        positions_last_contact,
        f"WITH {STATES_SQL} SELECT {_POSITION}, max(last_contact) AS last_contact"
        f" FROM states GROUP BY {_POSITION}",
    ),
    "positions_last_contact_country": (
        positions_last_contact_country,
        f"""
WITH {STATES_SQL}, latest AS (
  SELECT {_POSITION}, max(last_contact) AS t FROM states
  WHERE origin_country = '{_COUNTRY}' GROUP BY {_POSITION})
SELECT {_POSITION},
  strftime(make_timestamp((t - 28800) * 1000000), '%Y-%m-%d %H:%M:%S') AS last_contact
FROM latest""",
    ),
    "latest_positions": (latest_positions, _latest_sql()),
    "latest_positions_country": (
        latest_positions_country,
        _latest_sql(f"origin_country = '{_COUNTRY}'"),
    ),
    "flight_track": (
        flight_track,
        f"WITH {STATES_SQL} SELECT {_TRACK} FROM states WHERE {_FLIGHT}",
    ),
    "path_segments": (path_segments, _segments_sql("origin_country, callsign")),
    "path_segments_flight": (
        path_segments_flight,
        _segments_sql("origin_country, callsign", _FLIGHT),
    ),
    "path_segments_aircraft": (path_segments_aircraft, _segments_sql("icao24")),
    "path_segments_sliced": (path_segments_sliced, _segments_sql("origin_country, callsign")),
    "contact_time_text": (
        contact_time_text,
        f"""
WITH {STATES_SQL} SELECT event_id,
  strftime(make_timestamp(last_contact * 1000000), '%Y-%m-%d %H:%M:%S') AS contact_utc,
  strftime(make_timestamp((last_contact - 28800) * 1000000), '%Y-%m-%d %H:%M:%S') AS contact_pst
FROM states""",
    ),
    "epoch_to_timestamp": (
        epoch_to_timestamp,
        f"WITH {STATES_SQL} SELECT event_id,"
        " epoch_us(make_timestamp(last_contact * 1000000)) AS contact_micros FROM states",
    ),
    "distinct_countries": (
        distinct_countries,
        f"WITH {STATES_SQL} SELECT DISTINCT origin_country FROM states",
    ),
    "run_sql_named": (
        run_sql_named,
        f"WITH {STATES_SQL} SELECT {_TRACK} FROM states"
        f" WHERE origin_country = '{_COUNTRY}' AND velocity > 10.0",
    ),
}
