"""From message bodies to fare rows; the same functions serve batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farewind.functions import body_text
from farewind.schemas import FARE


def flatten_struct(
    df: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """The fields of a struct column as columns, followed by the kept ones."""
    return df.select(*[F.col(f"{column}.{name}") for name in schema.names], *keep)


def decode_fare_events(
    events: DataFrame,
    delay: Column | None = None,
    journey_date: Column | None = None,
    body: str = "body",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fare events (JSON in a binary or text ``body``) as rows of the streamed fare table.

    Text that is not JSON gives null fields; so do a field of the wrong type and a field name
    in another case. The journey date of the event is replaced by ``journey_date`` (default:
    today), and ``delay`` (default: null) becomes the text column ``DelayTime``.
    """
    delay = F.lit(None) if delay is None else delay
    journey_date = F.current_date() if journey_date is None else journey_date
    parsed = events.select(
        F.from_json(body_text(body), FARE).alias("__body"),
        delay.cast("string").alias("DelayTime"),
        journey_date.cast("date").alias("__journey"),
        *keep,
    )
    flat = flatten_struct(parsed, "__body", FARE, keep=["DelayTime", "__journey", *keep])
    return flat.drop("Date_Of_Journey").withColumnRenamed("__journey", "Date_of_Journey")
