from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farewind import schemas, sinks, sources, streaming
from farewind.scratch import new_folder
from tests.fixture_rows import FARE_ROWS


def fare_table(spark, files=1):
    rows = FARE_ROWS * 4
    return spark.createDataFrame(rows, schemas.FARE).repartition(files)


def landed(spark, df):
    path = new_folder(spark, "landed")
    sinks.write_table(df, path)
    return path


def rows_of(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def finish(query):
    assert streaming.run_available(query, 300)


def test_bodies(spark):
    fields = dict(zip(schemas.FARE.names, FARE_ROWS[0]))
    bodies = [
        json.dumps(fields), "no json", json.dumps({**fields, "Price": "dear"}),
        json.dumps({"airline": "lower case", "Source": "Delhi"}), None,
    ]
    events = spark.createDataFrame(
        [(i, None if b is None else b.encode(), i * 2) for i, b in enumerate(bodies)],
        "i int, body binary, late int",
    )
    decoded = streaming.decode_fare_events(
        events, F.col("late"), F.lit("2024-01-02"), keep=["i"]
    ).orderBy("i")
    assert decoded.drop("i").schema == schemas.STREAMED_FARE
    full, broken, misprised, cased, missing = decoded.collect()
    assert (full.Airline, full.Price, full.DelayTime) == ("CheeseAir", 1, "0")
    assert full.Date_of_Journey == date(2024, 1, 2)
    assert (broken.Airline, broken.Price, broken.DelayTime) == (None, None, "2")
    assert (misprised.Airline, misprised.Price) == ("CheeseAir", None)
    assert (cased.Airline, cased.Source) == (None, "Delhi")
    assert (missing.Airline, missing.DelayTime) == (None, "8")


def test_defaults(spark):
    events = spark.createDataFrame([(b"{}",)], "body binary")
    row = streaming.decode_fare_events(events).select("*", F.current_date().alias("today")).first()
    assert row.DelayTime is None and row.Date_of_Journey == row.today


@pytest.mark.parametrize("writer", ["table", "batches"])
def test_stream_equals_batch(spark, writer):
    df = fare_table(spark, files=5)
    stream = sources.stream_table(spark, landed(spark, df), schemas.FARE, max_files=2)
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    if writer == "table":
        finish(streaming.stream_to_table(stream, out, checkpoint))
        got = spark.read.parquet(out)
    else:
        finish(streaming.stream_batches_to_table(stream, out, checkpoint))
        got = streaming.read_batches(spark, out)
    assert rows_of(got) == rows_of(df)


def test_a_stream_resumes_where_it_stopped(spark):
    path, out = new_folder(spark, "landed"), new_folder(spark, "out")
    checkpoint = new_folder(spark, "checkpoint")
    for expected in (20, 40):
        sinks.write_table(fare_table(spark), path, mode="append")
        stream = sources.stream_table(spark, path, schemas.FARE)
        finish(streaming.stream_batches_to_table(stream, out, checkpoint))
        assert streaming.read_batches(spark, out).count() == expected


def test_another_checkpoint_appends(spark):
    path, out = landed(spark, fare_table(spark)), new_folder(spark, "out")
    for expected in (20, 40):  # the second run knows nothing of the first
        stream = sources.stream_table(spark, path, schemas.FARE)
        finish(streaming.stream_batches_to_table(stream, out, new_folder(spark, "checkpoint")))
        assert streaming.read_batches(spark, out, schemas.FARE).count() == expected


def test_a_repeated_batch_replaces_itself(spark):
    path, out = landed(spark, fare_table(spark, files=2)), new_folder(spark, "out")
    checkpoint = new_folder(spark, "checkpoint")
    for _ in range(2):
        stream = sources.stream_table(spark, path, schemas.FARE, max_files=1)
        finish(streaming.stream_batches_to_table(stream, out, checkpoint))
        assert streaming.read_batches(spark, out).count() == 20
        commits = Path(checkpoint) / "commits"  # as if the last batch had not been committed
        for name in ("1", ".1.crc"):
            (commits / name).unlink()


def test_a_column_named_like_a_batch_stays(spark):
    df = spark.createDataFrame([(7, 1)], "batch_id int, v int")
    out = new_folder(spark, "out")
    stream = sources.stream_table(spark, landed(spark, df), df.schema)
    finish(streaming.stream_batches_to_table(stream, out, new_folder(spark, "checkpoint")))
    assert [tuple(r) for r in streaming.read_batches(spark, out, df.schema).collect()] == [(7, 1)]


def test_preview_of_several_batches(spark):
    stream = sources.stream_table(spark, landed(spark, fare_table(spark, 4)), schemas.FARE, max_files=1)
    out, order = new_folder(spark, "out"), [F.asc("Price")]
    finish(streaming.stream_preview(stream, out, new_folder(spark, "checkpoint"), order, rows=3))
    assert streaming.read_batches(spark, out).count() > 3
    assert [r.Price for r in streaming.read_preview(spark, out, order, rows=3).collect()] == [1, 1, 1]


def test_csv_stream(spark):
    path = new_folder(spark, "csv")
    df = fare_table(spark, files=3)
    sinks.write_table(df, path, fmt="csv", header=True)
    out = new_folder(spark, "out")
    stream = sources.stream_fares_csv(spark, path, max_files=1)
    finish(streaming.stream_to_table(stream, out, new_folder(spark, "checkpoint")))
    assert rows_of(spark.read.parquet(out)) == rows_of(df)


def test_delays_add_up_over_batches(spark):
    rows = [("A", "5"), ("A", "15"), ("B", "x"), ("A", "1"), ("B", None), ("C", "60")]
    df = spark.createDataFrame(rows, "Airline string, DelayTime string").repartition(4)
    out = new_folder(spark, "out")
    stream = sources.stream_table(spark, landed(spark, df), df.schema, max_files=1)
    finish(streaming.stream_delay_summary(stream, out, new_folder(spark, "checkpoint")))
    got = {r.Airline: tuple(r)[1:] for r in streaming.read_delay_summary(spark, out).collect()}
    assert got == {
        "A": (3, 21.0, 15.0, 7.0), "B": (0, None, None, None), "C": (1, 60.0, 60.0, 60.0)
    }


def test_named_table_as_source_and_sink(spark):
    name = new_folder(spark, "t").rsplit("/", 1)[1].replace("-", "_")
    sinks.ensure_table(spark, name, schemas.FARE, path=new_folder(spark, "named"))
    stream = sources.stream_table(spark, landed(spark, fare_table(spark)), schemas.FARE)
    finish(streaming.stream_to_table(stream, name, new_folder(spark, "checkpoint")))
    out = new_folder(spark, "out")
    again = sources.stream_table(spark, name)
    finish(streaming.stream_batches_to_table(again, out, new_folder(spark, "checkpoint")))
    assert streaming.read_batches(spark, out).count() == 20
    sinks.drop_tables(spark, [name])


def test_preview_and_console(spark):
    path = landed(spark, fare_table(spark))
    stream = sources.stream_table(spark, path, schemas.FARE)
    out = new_folder(spark, "out")
    finish(
        streaming.stream_preview(
            stream, out, new_folder(spark, "checkpoint"), [F.asc("Price")], rows=3
        )
    )
    assert [r.Price for r in streaming.read_batches(spark, out).collect()] == [1, 1, 1]
    query = streaming.stream_to_console(stream, new_folder(spark, "checkpoint"), rows=2)
    finish(query)
    assert query.lastProgress["numInputRows"] == 20
    assert "Console" in query.lastProgress["sink"]["description"]


def test_a_running_stream_is_stopped_in_time(spark):
    stream = sources.stream_table(spark, landed(spark, fare_table(spark)), schemas.FARE)
    query = streaming.stream_to_table(
        stream, new_folder(spark, "out"), new_folder(spark, "checkpoint"), available_now=False
    )
    assert streaming.run_available(query, 3) is False
    assert not query.isActive


def test_broker_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.stream_broker(
            spark, {"kafka.bootstrap.servers": "nowhere:9093", "subscribe": "fares"}
        )
