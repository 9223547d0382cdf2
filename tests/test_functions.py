from __future__ import annotations

import base64
import hashlib
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farewind.functions import (
    days_after,
    decode_body,
    duration_minutes,
    encode_body,
    epoch_text,
    epoch_timestamp,
    hash_bucket,
    price_band,
    rating_delay,
    rating_preference,
)


def column(spark, values, kind, expression):
    """The expression over a column ``v``, row by row."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").coalesce(1)
    return [row[0] for row in rows.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    ("text", "minutes"),
    [
        ("2h 30m", 150), ("2h", 120), ("5m", 5), ("0h 0m", 0), ("x", None), ("", None),
        (None, None), ("99999999999h", None), ("99999999999999999999h 1m", None), ("h m", None),
    ],
)
def test_duration(spark, text, minutes):
    assert column(spark, [text], "string", duration_minutes("v")) == [minutes]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 5000)), min_size=50, max_size=200))
def test_duration_is_arithmetic(spark, parts):
    texts = [f"{h}h {m}m" for h, m in parts]
    assert column(spark, texts, "string", duration_minutes("v")) == [h * 60 + m for h, m in parts]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)), min_size=50, max_size=200)
)
def test_price_band_is_floor_division(spark, prices):
    prices += [0, 499, 500, -1, None]
    expected = [
        None if p is None else f"{p // 500 * 500}~{p // 500 * 500 + 500}" for p in prices
    ]
    assert column(spark, prices, "int", price_band("v")) == expected


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 10**6), st.integers(0, 10**4), st.integers(0, 60), st.integers(0, 30)
        ),
        min_size=50,
        max_size=100,
    )
)
def test_ratings_are_arithmetic(spark, rows):
    df = spark.createDataFrame(
        [(i, p, m, str(d), float(a)) for i, (p, m, d, a) in enumerate(rows)],
        "i int, p int, m int, d string, a double",
    )
    got = df.select(
        rating_delay("p", "m", "d", "a").alias("x"), rating_preference("p", "m", "a").alias("y"), "i"
    ).orderBy("i").collect()
    for (p, m, d, a), row in zip(rows, got):
        delay = 0.3 * d + 0.5 * (1 / (p + 1)) + 0.1 * (1 / (m + 1)) + 0.1 * a
        preference = 0.7 * a + 0.2 * (1 / (p + 1)) + 0.1 * (1 / (m + 1))
        assert (row.x, row.y) == (float(np.float32(delay)), float(np.float32(preference)))


def test_ratings_of_odd_inputs_are_null(spark):
    df = spark.createDataFrame(
        [(-1, 10, "5"), (None, 10, "5"), (10, None, "5"), (10, 10, "late")],
        "p int, m int, d string",
    )
    rows = df.select(rating_delay("p", "m", "d", F.lit(1.0)).alias("r")).collect()
    assert [row.r for row in rows] == [None] * 4


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_text_in_any_session_zone(spark, zone):
    # 1710054000 is in the hour New York skips in spring.
    seconds = [0, 1, -1, 1710054000, 1726750000, None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        utc = column(spark, seconds, "bigint", epoch_text("v"))
        west = column(spark, seconds, "bigint", epoch_text("v", -8))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def text(second, hours):
        if second is None:
            return None
        at = datetime.fromtimestamp(second, timezone(timedelta(hours=hours)))
        return at.strftime("%Y-%m-%d %H:%M:%S")

    assert utc == [text(s, 0) for s in seconds]
    assert west == [text(s, -8) for s in seconds]


def test_epoch_timestamp(spark):
    assert column(spark, [1726750000], "bigint", F.unix_micros(epoch_timestamp("v"))) == [
        1726750000 * 10**6
    ]


def test_days_after(spark):
    assert column(spark, [date(2024, 2, 28)], "date", days_after("v", F.lit(2))) == [
        date(2024, 3, 1)
    ]


def test_base64_both_ways(spark):
    bodies = [b"", b"a", "größe".encode(), bytes(range(256)), None]
    coded = column(spark, bodies, "binary", encode_body("v"))
    # Spark breaks long base64 text into lines.
    assert [None if c is None else bytes(c).replace(b"\r\n", b"") for c in coded] == [
        None if b is None else base64.b64encode(b) for b in bodies
    ]
    back = column(spark, bodies, "binary", decode_body(encode_body("v")))
    assert [None if b is None else bytes(b) for b in back] == bodies


def test_hash_bucket(spark):
    keys = [f"key {i}" for i in range(200)]
    got = column(spark, keys, "string", hash_bucket("v", 7))
    assert got == [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 7 for k in keys]
    assert set(got) == set(range(7))
