"""Event decoding and streams.

The streams run until they have read all of a given table, or of a table another stream has
written, and what they wrote is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from farewind import sinks, sources, streaming
from farewind.functions import body_text, days_after, decode_body, encode_body, hash_bucket
from farewind.plans.bindings import (
    FARES,
    FARES_SQL,
    NEW_FARES,
    NEW_FARES_SQL,
    comparable,
    fares,
    table,
)
from farewind.plans.fare_queries import line_key, bucket_sql
from farewind.schemas import BROKER_ENVELOPE, FARE, STREAMED_FARE
from farewind.scratch import new_folder

_MAX_FILES = 8  # files of a given table in one batch
_IDS = ("l_orderkey", "l_linenumber")
_FIRST_DAY = "2024-01-01"
_UNREADABLE = "AIR_AO"
_MISPRICED = "AIR_RF"


def _events(spark, sf_dir, body="body"):
    """Fares as messages: one airline sends no JSON, one sends prices that are not numbers."""
    return _messages(fares(spark, sf_dir), body)


def _messages(rows, body="body"):
    price_text = F.struct(*FARE.names[:-1], F.lit("n/a").alias("Price"))
    message = (
        F.when(F.col("Airline") == _UNREADABLE, F.concat(F.lit("offer "), "Route"))
        .when(F.col("Airline") == _MISPRICED, F.to_json(price_text))
        .otherwise(F.to_json(F.struct(*FARE.names)))
    )
    return rows.select(*_IDS, message.cast("binary").alias(body))


def _decoded(events, body="body", key=None, keep=_IDS):
    """The events with a delay and a journey date that follow from their key."""
    key = line_key() if key is None else key
    delay = hash_bucket(key, 61)
    journey = days_after(F.lit(_FIRST_DAY).cast("date"), hash_bucket(key, 2))
    return streaming.decode_fare_events(events, delay, journey, body=body, keep=keep)


def decode_events_batch(spark, sf_dir):
    return comparable(_decoded(_events(spark, sf_dir)))


def _arriving(spark, sf_dir, name):
    """A given table as a stream; the glob matches it as one file or as a folder."""
    schema = table(spark, sf_dir, name).schema
    return sources.stream_table(spark, f"{sf_dir}/{name}.parque[t]", schema, max_files=_MAX_FILES)


def _arriving_fares(spark, sf_dir):
    return _arriving(spark, sf_dir, "lineitem").selectExpr(*FARES)


def _finish(query):
    streaming.run_available(query)


def decode_events_stream(spark, sf_dir):
    events = _messages(_arriving_fares(spark, sf_dir))
    out = new_folder(spark, "decoded")
    _finish(
        streaming.stream_batches_to_table(_decoded(events), out, new_folder(spark, "checkpoint"))
    )
    return comparable(streaming.read_batches(spark, out))


def broker_envelope_decode(spark, sf_dir):
    """The broker's envelope, fed from files."""
    rows = _events(spark, sf_dir, body="value").select(
        F.concat_ws("-", *_IDS).cast("binary").alias("key"),
        "value",
        F.lit("fares").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("l_orderkey").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
    )
    path = new_folder(spark, "envelopes")
    sinks.write_table(rows, path)
    envelopes = sources.stream_broker(spark, {"path": path}, fmt="parquet", schema=BROKER_ENVELOPE)
    decoded = _decoded(envelopes, body="value", key=body_text("key"), keep=())
    out = new_folder(spark, "decoded")
    _finish(streaming.stream_to_table(decoded, out, new_folder(spark, "checkpoint")))
    return comparable(spark.read.schema(STREAMED_FARE).parquet(out))


def body_base64(spark, sf_dir):
    bodies = table(spark, sf_dir, "events").select("event_id", encode_body("props").alias("coded"))
    return bodies.select(
        "event_id",
        body_text("coded").alias("coded"),
        body_text(decode_body("coded")).alias("body"),
    )


def json_decode(spark, sf_dir):
    parsed = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


def explode_struct_array(spark, sf_dir):
    parsed = F.from_json("props", "k int")["k"].cast("double")
    pair = F.array(
        F.struct(F.col("event_type").alias("label"), F.col("value").alias("amount")),
        F.struct(F.lit("k").alias("label"), parsed.alias("amount")),
    )
    entries = table(spark, sf_dir, "events").select("event_id", F.explode(pair).alias("entry"))
    return entries.select("event_id", "entry.label", "entry.amount")


def stream_append_parquet(spark, sf_dir):
    lines = _arriving(spark, sf_dir, "lineitem")
    out = new_folder(spark, "lines")
    wanted = lines.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    _finish(streaming.stream_to_table(wanted, out, new_folder(spark, "checkpoint")))
    return spark.read.parquet(out)


def stream_foreach_batch(spark, sf_dir):
    """Two streams with a checkpoint each append to one table: fares, and new fares."""
    out = new_folder(spark, "fares")
    lines = _arriving_fares(spark, sf_dir).select(*FARE.names)
    orders = _arriving(spark, sf_dir, "orders").selectExpr(*NEW_FARES)
    for stream in (lines, orders):
        _finish(streaming.stream_batches_to_table(stream, out, new_folder(spark, "checkpoint")))
    return streaming.read_batches(spark, out, FARE)


def csv_stream(spark, sf_dir):
    path = new_folder(spark, "fares-csv")
    sinks.write_table(fares(spark, sf_dir).select(*FARE.names), path, fmt="csv", header=True)
    out = new_folder(spark, "fares")
    stream = sources.stream_fares_csv(spark, path)
    _finish(streaming.stream_to_table(stream, out, new_folder(spark, "checkpoint")))
    return spark.read.schema(FARE).parquet(out)


def stream_delay_summary(spark, sf_dir):
    """The delays in the table that the event stream writes."""
    events = _messages(_arriving_fares(spark, sf_dir))
    written = new_folder(spark, "decoded")
    decoded = _decoded(events, keep=())
    _finish(streaming.stream_to_table(decoded, written, new_folder(spark, "checkpoint")))
    out = new_folder(spark, "delays")
    growing = sources.stream_table(spark, written, STREAMED_FARE, max_files=_MAX_FILES)
    _finish(streaming.stream_delay_summary(growing, out, new_folder(spark, "checkpoint")))
    return streaming.read_delay_summary(spark, out)


def stream_preview_rows(spark, sf_dir):
    """The cheapest rows of a table written in several files, one batch each."""
    path = new_folder(spark, "arriving")
    rows = fares(spark, sf_dir).select("Airline", "Source", "Price")
    sinks.write_table(rows.repartition(4), path)
    stream = sources.stream_table(spark, path, rows.schema, max_files=1)
    out = new_folder(spark, "preview")
    order = [F.asc("Price"), F.asc("Airline"), F.asc("Source")]
    _finish(streaming.stream_preview(stream, out, new_folder(spark, "checkpoint"), order))
    return streaming.read_preview(spark, out, order)


_FARE_COLUMNS = ", ".join(FARE.names)
_TEXT_FIELDS = [name for name in FARE.names if name not in ("Date_Of_Journey", "Price")]


def _decoded_sql(ids: str) -> str:
    fields = ", ".join(
        f"CASE WHEN Airline = '{_UNREADABLE}' THEN NULL ELSE {name} END AS {name}"
        for name in _TEXT_FIELDS
    )
    return f"""SELECT {ids}{fields},
  CASE WHEN Airline IN ('{_UNREADABLE}', '{_MISPRICED}') THEN NULL ELSE Price END AS Price,
  cast({bucket_sql(61)} AS varchar) AS DelayTime,
  cast(cast(date '{_FIRST_DAY}' + {bucket_sql(2)} AS date) AS varchar) AS Date_of_Journey
FROM fares"""


_DECODED = f"WITH {FARES_SQL} {_decoded_sql('l_orderkey, l_linenumber, ')}"

QUERIES = {
    "decode_events_batch": (decode_events_batch, _DECODED),
    "decode_events_stream": (decode_events_stream, _DECODED),
    "broker_envelope_decode": (broker_envelope_decode, f"WITH {FARES_SQL} {_decoded_sql('')}"),
    "body_base64": (
        body_base64,
        "SELECT event_id, to_base64(encode(props)) AS coded, props AS body FROM events",
    ),
    "json_decode": (
        json_decode,
        "SELECT event_id, cast(json_extract(props, '$.k') AS int) AS k FROM events",
    ),
    "explode_struct_array": (
        explode_struct_array,
        """SELECT event_id, entry.label AS label, entry.amount AS amount FROM (
  SELECT event_id, unnest([
    {'label': event_type, 'amount': value},
    {'label': 'k', 'amount': cast(json_extract(props, '$.k') AS double)}]) AS entry
  FROM events) entries""",
    ),
    "stream_append_parquet": (
        stream_append_parquet,
        "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem",
    ),
    "stream_foreach_batch": (
        stream_foreach_batch,
        f"WITH {FARES_SQL}, {NEW_FARES_SQL} SELECT {_FARE_COLUMNS} FROM fares"
        f" UNION ALL SELECT {_FARE_COLUMNS} FROM new_fares",
    ),
    "csv_stream": (csv_stream, f"WITH {FARES_SQL} SELECT {_FARE_COLUMNS} FROM fares"),
    "stream_delay_summary": (
        stream_delay_summary,
        f"""
WITH {FARES_SQL}, decoded AS ({_decoded_sql('')})
SELECT Airline, count(DelayTime) AS n, sum(cast(DelayTime AS double)) AS total_delay,
  max(cast(DelayTime AS double)) AS max_delay,
  sum(cast(DelayTime AS double)) / count(DelayTime) AS mean_delay
FROM decoded GROUP BY Airline""",
    ),
    "stream_preview_rows": (
        stream_preview_rows,
        f"WITH {FARES_SQL} SELECT Airline, Source, Price FROM fares"
        " ORDER BY Price, Airline, Source LIMIT 20",
    ),
}
