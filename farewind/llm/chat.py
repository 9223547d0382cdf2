"""Chat logs: collapse cumulative snapshots of a conversation, then render what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farewind.scratch import stored

# The turn marks of the rendered form.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"

_STATE = ["h1", "h2"]


def _turn_order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("turn", "role", "t1", "t2")]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, pos (1-based) and two 64-bit hashes of all turns up to it.

    The hash rolls: each turn's hash is bound to its position and joined to the state by xor,
    so that the state after n turns identifies the first n (role, text) pairs.
    """
    content = F.struct(F.col("role").isNull(), F.col("text").isNull(), "role", "text")
    narrow = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", "role",
        F.xxhash64(F.lit(1), content).alias("t1"),
        F.xxhash64(F.lit(2), content).alias("t2"),
    )
    ordered = Window.partitionBy("conv_id").orderBy(*_turn_order())
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = narrow.withColumn("pos", F.row_number().over(ordered))
    return placed.select(
        "conv_id", "pos",
        F.bit_xor(F.xxhash64("pos", "t1")).over(so_far).alias("h1"),
        F.bit_xor(F.xxhash64("pos", "t2", F.lit(3))).over(so_far).alias("h2"),
        (F.lead("pos").over(ordered).isNull()).alias("is_last"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that are no prefix of a longer one.

    Of equal conversations the smallest conv_id stays and n_copies counts them.
    """
    states = prefix_hashes(turns)
    whole = (
        states.filter("is_last")
        .groupBy("pos", *_STATE)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    inner = states.filter("not is_last").select("pos", *_STATE).distinct()
    return whole.join(inner, ["pos", *_STATE], "left_anti").select(
        "conv_id", F.col("pos").cast("long").alias("n_turns"), "n_copies"
    )


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """Adds ``rendered`` to the rows of ``kept``: the turns of each in order, between marks."""
    content = F.struct(F.col("role").isNull(), F.col("text").isNull(), "role", "text")
    spoken = turns.select(
        "conv_id", "turn", "role",
        F.xxhash64(F.lit(1), content).alias("t1"),
        F.xxhash64(F.lit(2), content).alias("t2"),
        "text",
    ).join(kept.select("conv_id"), "conv_id", "left_semi")
    lists = spoken.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "t1", "t2", "text"))).alias("said")
    )
    text = F.array_join(
        F.transform(
            "said",
            lambda t: F.concat(
                F.lit(TURN_START), F.coalesce(t["role"], F.lit("")), F.lit("\n"),
                F.coalesce(t["text"], F.lit("")), F.lit(f"{TURN_END}\n"),
            ),
        ),
        "",
    )
    return kept.join(lists.select("conv_id", text.alias("rendered")), "conv_id")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Maximal conversations of ``turns`` (conv_id, turn, role, text), rendered.

    Turns are ordered by turn, ties by role and then by content, nulls first; a row that
    repeats is a turn of its own. Null roles and texts are rendered as empty. Rows without a
    conv_id belong to no conversation and are left out. Other columns are ignored. Runs a job
    when called.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    return render(turns, stored(maximal_conversations(turns), "maximal"))
