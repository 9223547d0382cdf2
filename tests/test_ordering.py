"""Slicing crowded groups must not change any result."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from farewind.operators.ordering import split_crowded, with_next, with_rank


def points(seed: int) -> list[tuple]:
    """Two crowded groups (one with a null key), one of them at a single time, and small ones."""
    chance = random.Random(seed)
    rows = [(1, "a", chance.randrange(50)) for _ in range(400)]
    rows += [(2, None, 7) for _ in range(300)]
    rows += [(chance.randrange(3, 40), "a", chance.randrange(50)) for _ in range(200)]
    chance.shuffle(rows)
    return [(g, k, t, i) for i, (g, k, t) in enumerate(rows)]


def expected_next(rows):
    groups = {}
    for row in rows:
        groups.setdefault((row[0], row[1]), []).append(row)
    found = set()
    for members in groups.values():
        members.sort(key=lambda row: (-row[2], -row[3]))
        for here, there in zip(members, members[1:]):
            found.add((*here, there[3], True))
        found.add((*members[-1], None, False))
    return found


@pytest.mark.parametrize("bound", [10**6, 100, 1, 0])
@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_next_row(spark, bound, partitions):
    rows = points(seed=bound)
    df = spark.createDataFrame(rows, "g int, k string, t int, i int").repartition(5)
    order = [F.desc("t"), F.desc("i")]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = with_next(df, ["g", "k"], order, ["i"], max_group_rows=bound).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == len(rows)
    assert {(r.g, r.k, r.t, r.i, r.next_i, r.has_next) for r in got} == expected_next(rows)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_next_row_with_and_without_merged_partitions(spark, coalesce):
    rows = points(seed=1)
    df = spark.createDataFrame(rows, "g int, k string, t int, i int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = with_next(df, ["g", "k"], [F.desc("t"), F.desc("i")], ["i"], 10).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {(r.g, r.k, r.t, r.i, r.next_i, r.has_next) for r in got} == expected_next(rows)


def test_split_keeps_every_row(spark):
    rows = points(seed=2)
    df = spark.createDataFrame(rows, "g int, k string, t int, i int")
    roomy, crowded = split_crowded(df, ["g", "k"], 100)
    assert {(r.g, r.k) for r in crowded.select("g", "k").distinct().collect()} == {
        (1, "a"), (2, None)
    }
    assert roomy.count() + crowded.count() == len(rows)
    assert split_crowded(df, ["g", "k"], 1000)[1] is None


def test_copies_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr("farewind.operators.ordering._COPY_BLOCK", 7)
    rows = [(1, "a", 5, 50)] * 300 + [(1, "a", 9, 90)] * 8 + [(1, "a", t, t) for t in (1, 7, 20)]
    rows += [(None, None, 3, 30)] * 200
    df = spark.createDataFrame(rows, "g int, k string, t int, i int").repartition(3)
    order = [F.desc("t")]
    got, plain = (
        sorted(map(str, with_next(df, ["g", "k"], order, ["i"], max_group_rows=n).collect()))
        for n in (10, 10**6)
    )
    assert got == plain and len(got) == len(rows)


def test_split_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr("farewind.operators.ordering.MAX_BROADCAST_KEYS", 1)
    rows = points(seed=3)
    df = spark.createDataFrame(rows, "g int, k string, t int, i int")
    got = with_next(df, ["g", "k"], [F.desc("t"), F.desc("i")], ["i"], 100).collect()
    assert {(r.g, r.k, r.t, r.i, r.next_i, r.has_next) for r in got} == expected_next(rows)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_rank(spark, partitions):
    chance = random.Random(4)
    rows = [(chance.choice([1, 1, 1, 2, 50]), f"label {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "n int, label string").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_rank(df, [F.desc("n"), F.asc("label")], "idx").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranked = sorted(rows, key=lambda row: (-row[0], row[1]))
    assert {(r.idx, r.n, r.label) for r in got} == {(i, *row) for i, row in enumerate(ranked)}


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "n int, label string")
    assert with_rank(df, [F.desc("n"), F.asc("label")], "idx").count() == 0
