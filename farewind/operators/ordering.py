"""Order-dependent work on groups of any size.

A window hands each of its groups to one task. The functions here cut a crowded group into
slices of the sort order first, so no task sees more than a slice, and then repair the seams
between slices. Results are exact whatever the slices are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farewind.scratch import stored

# Rows of one group that a single task may sort.
MAX_GROUP_ROWS = 2_000_000
# Crowded keys that may be sent to every executor; beyond it they are joined by shuffle.
MAX_BROADCAST_KEYS = 10_000

_SEAM = -1
# Copies of one row that a single task writes out.
_COPY_BLOCK = 100_000


def with_next(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``next_<value>`` from the following row of the group, and ``has_next``.

    Counts the groups first, by a job when called (one pre-aggregated pass over the key
    columns). Groups within ``max_group_rows`` take a plain window. If there are larger ones,
    the rows are stored once, and the larger groups are cut into slices.
    """
    roomy, crowded = split_crowded(df, group, max_group_rows)
    result = _next_in_window(roomy, group, order, values)
    if crowded is not None:
        result = result.unionByName(_next_among_copies(crowded, group, order, values))
    return result


def split_crowded(
    df: DataFrame, group: Sequence[str], max_group_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups within the bound, and rows of larger groups (None when there are none)."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__rows"))
    large = counts.filter(F.col("__rows") > max_group_rows).select(*group)
    found = large.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not found:
        return df, None
    df = stored(df, "crowded")
    if len(found) <= MAX_BROADCAST_KEYS:
        large = F.broadcast(df.sparkSession.createDataFrame(found, large.schema))
    large = large.alias("large")
    rows = df.alias("rows")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"rows.{name}").eqNullSafe(F.col(f"large.{name}")) for name in group],
    )
    return rows.join(large, same, "left_anti"), rows.join(large, same, "left_semi")


def _next_in_window(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    following = Window.partitionBy(*group).orderBy(*order)
    return df.select(
        "*",
        *[F.lead(name).over(following).alias(f"next_{name}") for name in values],
        F.lead(F.lit(True), 1, False).over(following).alias("has_next"),
    )


def _next_among_copies(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """Neighbours in crowded groups, whose rows may also be copies of each other.

    Copies have one place in any order, so no slicing can separate them. They are counted on
    the map side instead: the last copy precedes the next different row, and each other copy
    precedes a copy of itself.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    total_order = [*order, *[F.asc(name) for name in columns]]
    last_copies = _next_across_slices(counted, group, total_order, values).drop("__copies")

    others = F.col("__copies") - 1
    blocks = counted.filter(others > 0).select(
        *columns, "__copies",
        F.explode(F.sequence(F.lit(0), F.ceil(others / _COPY_BLOCK) - 1)).alias("__block"),
    )
    in_block = F.least(others - F.col("__block") * _COPY_BLOCK, F.lit(_COPY_BLOCK))
    spread = blocks.repartition(*columns, "__block")
    repeated = spread.withColumn("__copy", F.explode(F.sequence(F.lit(1), in_block)))
    return last_copies.unionByName(
        repeated.select(
            *columns, *[F.col(name).alias(f"next_{name}") for name in values],
            F.lit(True).alias("has_next"),
        )
    )


def _next_across_slices(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    # 1. Within a slice of a group: neighbours, and which rows touch a seam.
    in_slice = Window.partitionBy(*group, "__slice").orderBy(*order)
    placed = _sliced(df, [*[F.col(name) for name in group], *order]).select(
        "*",
        *[F.lead(name).over(in_slice).alias(f"next_{name}") for name in values],
        F.lag(F.lit(False), 1, True).over(in_slice).alias("__first"),
        F.lead(F.lit(False), 1, True).over(in_slice).alias("__last"),
    )
    # 2. The first and last row of every slice meet in one small window per group; all other
    #    rows stay spread over their slices.
    part = F.when(F.col("__first") | F.col("__last"), F.lit(_SEAM)).otherwise(F.col("__slice"))
    over_seam = Window.partitionBy(*group, "__part").orderBy("__slice", *order)
    joined = placed.withColumn("__part", part)
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("__last"), F.lead(name).over(over_seam))
            .otherwise(F.col(f"next_{name}"))
            .alias(f"next_{name}")
            for name in values
        ],
        F.when(F.col("__last"), F.lead(F.lit(True), 1, False).over(over_seam))
        .otherwise(F.lit(True))
        .alias("has_next"),
    )


def with_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row in a total order, without a single-task sort."""
    in_slice = Window.partitionBy("__slice").orderBy(*order)
    slice_rows = Window.partitionBy("__slice")
    placed = (
        _sliced(df, order)
        .withColumn("__place", F.row_number().over(in_slice).cast("bigint"))
        .withColumn("__size", F.count(F.lit(1)).over(slice_rows))
    )
    # One row per slice carries its size past the seams of all earlier slices.
    last = F.col("__place") == F.col("__size")
    before = Window.partitionBy("__part").orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = placed.withColumn(
        "__part", F.when(last, F.lit(_SEAM)).otherwise(F.col("__slice"))
    ).withColumn(
        "__before", F.when(last, F.coalesce(F.sum("__size").over(before), F.lit(0)))
    )
    offset = F.max("__before").over(slice_rows)
    return carried.select(*df.columns, (offset + F.col("__place") - 1).alias(name))


def _sliced(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition by the whole order; ``__slice`` numbers the ranges in that order.

    The slice number is only used inside the one plan that computes it, so it need not be
    the same when the plan is run again.
    """
    return df.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id())
