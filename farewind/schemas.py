"""Schemas of the flight tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_text, _int, _long, _double = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# The column names of a fare row, in file order.
FARE_TEXT_COLUMNS = (
    "Airline", "Date_Of_Journey", "Source", "Destination", "Route", "Dep_Time",
    "Arrival_Time", "Duration", "Total_Stops", "Additional_Info",
)

FARE = _struct(**{name: _text for name in FARE_TEXT_COLUMNS}, Price=_int)

# A fare is the same offer when everything but the price agrees.
FARE_KEYS = FARE_TEXT_COLUMNS

QUOTE = _struct(
    updatedTime=T.TimestampType(),
    flight_departure=_text,
    source=_text,
    destination=_text,
    price=T.DecimalType(10, 2),
)
QUOTE_KEYS = ("flight_departure", "source", "destination")

# The positions of an aircraft state array and their column names.
STATE = _struct(
    icao24=_text,
    callsign=_text,
    origin_country=_text,
    time_position=_long,
    last_contact=_long,
    longitude=_double,
    latitude=_double,
    baro_altitude=_double,
    on_ground=T.BooleanType(),
    velocity=_double,
    true_track=_double,
    vertical_rate=_double,
    sensors=T.ArrayType(_int),
    geo_altitude=_double,
    squawk=_text,
    spi=T.BooleanType(),
    position_source=_int,
)

STREAMED_FARE = T.StructType(
    [field for field in FARE if field.name != "Date_Of_Journey"]
    + [
        T.StructField("DelayTime", _text, True),
        T.StructField("Date_of_Journey", T.DateType(), True),
    ]
)

# The envelope a Kafka-protocol source yields; the event itself is in ``value``.
BROKER_ENVELOPE = _struct(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=_text,
    partition=_int,
    offset=_long,
    timestamp=T.TimestampType(),
)

# Columns that turn rows of a table into rows of its change log.
CHANGE_COLUMNS = _struct(_version=_long, _commit_ts=T.TimestampType(), _op=_text)
QUOTE_CHANGES = T.StructType(QUOTE.fields + CHANGE_COLUMNS.fields)
