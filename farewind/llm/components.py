"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farewind.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.filter("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (
        moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (a, b).

    Rows with a null end or equal ends link nothing; nodes without an edge to another are
    left out. Every round is written to a table in the shared folder, and the rounds end when
    the edges no longer change: each node then points at its smallest. Runs jobs when called.
    """
    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
