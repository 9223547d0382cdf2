from __future__ import annotations

import pytest

from farewind import schemas
from farewind.functions import epoch_text
from farewind.operators import positions


def state(icao24, callsign, last_contact, lon=1.0, lat=2.0, country="NL", time="same", speed=100.0):
    row = dict.fromkeys(schemas.STATE.names)
    row.update(
        icao24=icao24, callsign=callsign, origin_country=country, last_contact=last_contact,
        time_position=last_contact if time == "same" else time, longitude=lon, latitude=lat,
        velocity=speed, on_ground=False, spi=False,
    )
    return tuple(row.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.STATE)


def test_latest_position_per_aircraft(spark):
    df = frame(
        spark,
        state("a", "KL1", 10, lon=1.0), state("a", "KL2", 20, lon=5.0), state("b", None, 5),
        state("c", "KL3", 7, country="DE"), state("d", "KL4", None),
    )
    rows = {r.icao24: r for r in positions.latest_positions(df, "NL").collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].callsign, rows["a"].longitude, rows["a"].last_contact) == ("KL2", 5.0, 20)
    assert positions.latest_positions(df).count() == 3


def test_equal_contact_times_give_one_row(spark):
    df = frame(spark, *[state("a", "KL1", 10, lon=float(i)) for i in range(5)])
    assert [r.longitude for r in positions.latest_positions(df).collect()] == [4.0]


def test_last_contact_keeps_every_position(spark):
    df = frame(spark, state("a", "K", 10), state("a", "K", 30), state("a", "K", 20, lon=9.0))
    rows = positions.last_contact_by_position(df, "NL").collect()
    assert [(r.longitude, r.last_contact) for r in rows] == [(1.0, 30), (9.0, 20)]


def test_top_callsigns(spark):
    df = frame(
        spark, *[state("a", None, i) for i in range(3)], *[state("b", "B", i) for i in range(2)],
        *[state("c", "A", i) for i in range(2)], state("d", "D", 1),
    )
    assert positions.top_callsigns(df, k=3).collect() == [(None, 3), ("A", 2), ("B", 2)]
    assert positions.top_callsigns(df, k=1, label_nulls=True).collect() == [("None", 3)]


def test_track_is_latest_first(spark):
    df = frame(
        spark, state("a", "K", 1), state("a", "K", 3), state("b", "K", 2), state("a", None, 9)
    )
    track = positions.flight_track(df, "NL", "K")
    assert [r.last_contact for r in track.collect()] == [3, 2, 1]
    assert positions.flight_track(df, "NL", None).count() == 1
    assert positions.flight_track(df, "NL", "'; DROP").count() == 0


@pytest.mark.parametrize("bound", [10**6, 1])
def test_path_skips_unplaced_points(spark, bound):
    df = frame(
        spark,
        state("a", "K", 100, lon=1.0), state("a", "K", 200, lon=None), state("a", "K", 300, lon=3.0),
        state("a", "K", 400, lon=4.0, time=None), state("b", "K", 500, lon=5.0),
        state("c", "alone", 1),
    )
    lines = positions.path_segments(df, "NL", "K", max_group_rows=bound).collect()
    assert sorted((r.longitude, r.next_longitude, r.time_utc) for r in lines) == [
        (3.0, 1.0, "1970-01-01 00:05:00"), (5.0, 3.0, "1970-01-01 00:08:20"),
    ]
    own = positions.path_segments(df, per_aircraft=True, max_group_rows=bound).collect()
    assert [(r.icao24, r.longitude, r.next_longitude) for r in own] == [("a", 3.0, 1.0)]


def test_contact_text_eight_hours_west(spark):
    df = frame(spark, state("a", "K", 0)).select(epoch_text("last_contact", -8).alias("t"))
    assert df.first().t == "1969-12-31 16:00:00"
