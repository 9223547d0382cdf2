"""Route recommendations: label indexes, ratings, ALS and the tables around it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farewind.functions import price_band
from farewind.operators.ordering import split_crowded, with_rank
from farewind.scratch import ensure_checkpoint_dir, stored

#: Fares of a user that one task may meet recommendations with, and pieces of a larger user.
MAX_USER_FARES, SALTS = 1_000_000, 64
#: Fares, about, that a task joins with recommendations: the product is ten times as long, and is grouped there.
TASK_FARES = 250_000
#: Blocks of users, and of routes, that the solver makes at least, and about how many ratings a larger fit gives to one.
#: Every user meets every block of routes when recommended to, so these are fewer.
MIN_BLOCKS, USER_BLOCK_RATINGS, ROUTE_BLOCK_RATINGS = 10, 1_000_000, 8_000_000
# Copies of one fare that are dealt together.
_COPY_BLOCK = 1000

NULL_POLICIES = ("error", "skip", "keep")


# --- labels ------------------------------------------------------------------------------


def label_index(df: DataFrame, column: str) -> DataFrame:
    """(label, frequency, idx): the most frequent label is 0, ties go alphabetically."""
    return label_indexes(df, [column]).drop("column")


def label_indexes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, frequency, idx) of several columns, from one pass over the data.

    The ranking is distributed, so the number of labels is not limited by one machine: all
    labels get places in one order, and a column's indexes are counted from its first place.
    With several columns their frequencies are stored first, by a job when called.
    """
    order = [F.asc("column"), F.desc("frequency"), F.asc("label")]
    counts = _label_counts(df, columns)
    if len(columns) > 1:
        counts = stored(counts, "label-counts")
    placed = with_rank(counts, order, "__place")
    if len(columns) > 1:
        sizes = counts.groupBy("column").count()
        before = Window.orderBy("column").rowsBetween(Window.unboundedPreceding, -1)
        begins = sizes.select("column", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
        placed = placed.join(F.broadcast(begins), "column")  # one row per column
    else:
        placed = placed.withColumn("__first", F.lit(0))
    return placed.select(
        "column", "label", "frequency", (F.col("__place") - F.col("__first")).cast("double").alias("idx")
    )


def stored_label_indexes(df: DataFrame, columns: Sequence[str]) -> dict[str, LabelIndex]:
    """``label_index`` of several columns, kept in a table for repeated use. Runs jobs when called."""
    table = stored(label_indexes(df, columns), "labels")
    sizes = {row["column"]: row["count"] for row in table.groupBy("column").count().collect()}
    return {
        column: LabelIndex(table.filter(F.col("column") == column).drop("column"), sizes.get(column, 0))
        for column in columns
    }


def _label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("label"))
            for name in columns
        ]
    )
    labels = df.select(F.explode(pairs).alias("pair")).select("pair.column", "pair.label")
    return (
        labels.filter(F.col("label").isNotNull())
        .groupBy("column", "label")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


@dataclass(frozen=True)
class LabelIndex:
    """A label table (label, frequency, idx) whose number of rows is known."""

    table: DataFrame
    size: int

    def columns(self, **names: str) -> DataFrame:
        """Some columns under other names."""
        return self.table.select(*[F.col(old).alias(new) for old, new in names.items()])


def index_labels(
    df: DataFrame, outputs: Mapping[str, str], on_null: Mapping[str, str] | None = None
) -> tuple[DataFrame, dict[str, LabelIndex]]:
    """Add an index column per label column; also return the label tables.

    ``outputs`` maps label columns to index columns. A null label is an error unless
    ``on_null`` says ``skip`` (leave the row out) or ``keep`` (one index past the last). Runs
    jobs when called.
    """
    indexes = stored_label_indexes(df, list(outputs))
    for column, output in outputs.items():
        policy = (on_null or {}).get(column, "error")
        if policy not in NULL_POLICIES:
            raise ValueError(f"unknown policy for null labels: {policy}")
        df = _with_index(df, column, output, indexes[column], policy)
    return df, indexes


def _with_index(
    df: DataFrame, column: str, output: str, index: LabelIndex, policy: str
) -> DataFrame:
    table = index.columns(label=column, idx=output)
    if policy == "skip":
        return df.join(table, column).select(*df.columns, output)
    if policy == "keep":
        missing: Column = F.lit(float(index.size))
    else:
        missing = F.raise_error(F.lit(f"null label in {column}")).cast("double")
    joined = df.join(table, column, "left")
    return joined.select(*df.columns, F.coalesce(F.col(output), missing).alias(output))


def labels_for(df: DataFrame, index: LabelIndex, column: str, output: str) -> DataFrame:
    """Add the label behind an index column."""
    names = index.columns(idx="__idx", label=output)
    matches = F.col(column).cast("double") == F.col("__idx")
    return df.join(names, matches, "left").drop("__idx")


# --- ratings and model -------------------------------------------------------------------


def fit_routes(
    ratings: DataFrame,
    seed: int = 42,
    max_iter: int = 10,
    reg: float = 0.01,
    dedupe: str | None = None,
    blocks: int | None = None,
    on_null: str = "skip",
) -> ALSModel:
    """ALS over (userId, route_index, rating); the defaults are fixed values.

    Rows with a null among the three cannot be rated: they are left out, or with
    ``on_null="error"`` the fit fails.

    By default every row is one observation. ``dedupe="mean"`` first averages the rows of
    each (user, route), on the map side, so that a user with very many rows contributes at
    most one rating per route to the solver; repeated pairs then no longer weigh more.

    A task of the solver holds a block's ratings, so unless ``blocks`` is given the ratings are counted
    by a job, and the blocks are as many as they need. Each iteration's shuffle files are deleted after it.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    rows = ratings.select(
        F.col("userId").cast("int").alias("userId"),
        F.col("route_index").cast("int").alias("route_index"),
        F.col("rating").cast("float").alias("rating"),
    )
    if on_null == "error":
        missing = F.greatest(*[F.col(name).isNull() for name in rows.columns])
        problem = F.raise_error(F.lit("a row without user, route or rating")).cast("float")
        rows = rows.withColumn("rating", F.when(missing, problem).otherwise(F.col("rating")))
    elif on_null == "skip":
        rows = rows.na.drop()
    else:
        raise ValueError(f"unknown policy for nulls: {on_null}")
    if dedupe == "mean":
        rows = rows.groupBy("userId", "route_index").agg(
            F.avg("rating").cast("float").alias("rating")
        )
    elif dedupe is not None:
        raise ValueError(f"unknown dedupe: {dedupe}")
    als = ALS(
        maxIter=max_iter,
        regParam=reg,
        userCol="userId",
        itemCol="route_index",
        ratingCol="rating",
        coldStartStrategy="drop",
        checkpointInterval=1,
        seed=seed,
    )
    users, routes = (blocks, blocks) if blocks else _solver_blocks(rows)
    return als.setNumUserBlocks(users).setNumItemBlocks(routes).fit(rows)


def _solver_blocks(rows: DataFrame) -> tuple[int, int]:
    """How many blocks of users and of routes the solver needs for these ratings."""
    ratings = rows.count()
    return max(MIN_BLOCKS, -(-ratings // USER_BLOCK_RATINGS)), max(MIN_BLOCKS, -(-ratings // ROUTE_BLOCK_RATINGS))


def recommend_routes(model: ALSModel, labels: LabelIndex, k: int = 10) -> DataFrame:
    """The best ``k`` routes of every user as (userId, rank, ridx, route, rating).

    ``labels`` is the label table of the route index.
    """
    best = model.recommendForAllUsers(k).select(
        "userId", F.posexplode("recommendations").alias("__place", "recommendation")
    )
    flat = best.select(
        "userId",
        (F.col("__place") + 1).alias("rank"),
        F.col("recommendation.route_index").alias("ridx"),
        F.col("recommendation.rating").alias("rating"),
    )
    named = labels_for(flat, labels, "ridx", "route")
    return named.select("userId", "rank", "ridx", "route", "rating")


def recommendation_arrays(model: ALSModel, labels: LabelIndex, k: int = 10) -> DataFrame:
    """Like ``recommend_routes`` in the nested form: the whole list next to each entry."""
    nested = model.recommendForAllUsers(k).select(
        "userId", "recommendations", F.explode("recommendations").alias("recommendation")
    )
    nested = nested.withColumn("ridx", F.col("recommendation.route_index"))
    return labels_for(nested, labels, "ridx", "route")


# --- checks of a model -------------------------------------------------------------------


def best_routes_exact(model: ALSModel, users: DataFrame, k: int = 10, block: int = 512) -> DataFrame:
    """(userId, rank, ridx, rating) of the users in ``users`` (userId), by brute force.

    Every factor of an item is multiplied with the factors of all these users, in blocks: a block
    of users is one row, and every item meets each block once. Of a block of items only the best
    ``k`` per user go on, so no task ever has more than a block of them. Ties go to the smaller index.
    For a stated set of users: the work is their number times that of the items.
    """
    chosen = model.userFactors.join(users.select(F.col("userId").alias("id")).distinct(), "id", "left_semi")
    chosen = stored(chosen, "users")
    n_blocks = max(1, -(-chosen.count() // block))
    packed = chosen.groupBy(F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("__block")).agg(
        F.collect_list(F.struct("id", "features")).alias("__users")
    )
    items = model.itemFactors.select(F.col("id").alias("ridx"), F.col("features").alias("__item"))
    items = items.withColumn("__block", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")))
    met = items.join(packed, "__block").select("ridx", "__item", F.explode("__users").alias("__user"))
    rating = F.aggregate(
        F.zip_with("__user.features", "__item", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda so_far, x: so_far + x
    )
    scored = met.select(F.col("__user.id").alias("userId"), "ridx", rating.alias("rating"))
    entry = F.struct((-F.col("rating")).alias("cost"), "ridx")
    part = scored.groupBy("userId", F.pmod("ridx", F.lit(1 + model.itemFactors.count() // block)).alias("__part"))
    best = part.agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("__best"))
    best = best.groupBy("userId").agg(F.slice(F.sort_array(F.flatten(F.collect_list("__best"))), 1, k).alias("__best"))
    flat = best.select("userId", F.posexplode("__best").alias("__place", "__entry"))
    return flat.select(
        "userId", (F.col("__place") + 1).alias("rank"), F.col("__entry.ridx").alias("ridx"),
        (-F.col("__entry.cost")).alias("rating"),
    )


def fit_residuals(model: ALSModel, ratings: DataFrame, reg: float = 0.01) -> DataFrame:
    """(userId, n, residual): how far each user's factors are from solving their equations.

    The last half step of the solver fits the users to the items' final factors: a user's factors
    u solve sum(v (v·u - r)) + reg * n * u = 0 over the user's n ratings r and the items' factors v.
    The residual is the length of the left side against that of sum(v r); rounding alone is left
    if the fit is right. Sums are combined on the map side, so a crowded user is no one task's.
    """
    rows = ratings.select(
        F.col("userId").cast("int").alias("userId"), F.col("route_index").cast("int").alias("ridx"),
        F.col("rating").cast("float").cast("double").alias("r"),
    ).na.drop()
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").cast("array<double>").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("ridx"), F.col("features").cast("array<double>").alias("v"))
    # each distinct (user, item, rating) once, with its number of rows
    alike = rows.groupBy("userId", "ridx", "r").agg(F.count("*").alias("rows"))
    met = alike.join(items, "ridx").join(users, "userId")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda so_far, x: so_far + x)
    met = met.withColumns({"off": (dot - F.col("r")) * F.col("rows"), "pull": F.col("r") * F.col("rows")})
    k = range(model.rank)
    sums = met.groupBy("userId").agg(
        F.sum("rows").alias("n"), F.first("u").alias("u"),
        *[F.sum(F.col("v")[i] * F.col("off")).alias(f"off{i}") for i in k],
        *[F.sum(F.col("v")[i] * F.col("pull")).alias(f"pull{i}") for i in k],
    )
    left = [F.col(f"off{i}") + reg * F.col("n") * F.col("u")[i] for i in k]
    length = lambda parts: F.sqrt(sum((p * p for p in parts), F.lit(0.0)))
    whole = length([F.col(f"pull{i}") for i in k])
    return sums.select("userId", "n", F.when(whole > 0, length(left) / whole).otherwise(0.0).alias("residual"))


# --- tables built from recommendations ---------------------------------------------------


def route_sources(fares: DataFrame) -> DataFrame:
    """(Route, Source): where a route starts, by most fares, ties alphabetically."""
    pairs = fares.groupBy("Route", "Source").agg(F.count(F.lit(1)).alias("__n"))
    best = F.min_by("Source", F.struct(-F.col("__n"), "Source")).alias("Source")
    return pairs.filter(F.col("Source").isNotNull()).groupBy("Route").agg(best)


def recommend_with_source(recs: DataFrame, fares: DataFrame) -> DataFrame:
    """Recommended routes as (source_des, route) rows."""
    starts = route_sources(fares).select(
        F.col("Route").alias("route"), F.col("Source").alias("source_des")
    )
    return recs.join(starts, "route").select("source_des", "route")


def attach_fares(
    recs: DataFrame, fares: DataFrame, max_fares: int = MAX_USER_FARES, task_fares: int = TASK_FARES
) -> DataFrame:
    """Every recommendation of a user next to every fare of that user, with the price band.

    The result is the product of the two per user. Users with more than ``max_fares`` fares are
    counted out beforehand, by a job when called: their fares are dealt over SALTS pieces by a
    hash, and their few recommendations are copied to each piece. The others are dealt by user to
    as many tasks as their fares need, by their number: partitions sized by the bytes that reach the
    join would hold any number of its rows. The fares are counted by a job too.
    """
    offers = fares.select("userId", "Airline", "Price")
    roomy, crowded = split_crowded(offers, ["userId"], max_fares)
    tasks = -(-offers.count() // task_fares)
    if tasks > 1:
        recs, roomy = recs.repartition(tasks, "userId"), roomy.repartition(tasks, "userId")
    result = recs.join(roomy, "userId")
    if crowded is not None:
        # Copies of a fare cannot be told apart by a hash: they are counted, and dealt in blocks.
        counted = crowded.groupBy("userId", "Airline", "Price").agg(F.count(F.lit(1)).alias("__copies"))
        blocks = counted.withColumn("__block", F.explode(F.expr(f"sequence(0L, (__copies - 1) div {_COPY_BLOCK}L)")))
        dealt = blocks.select(
            "userId", "Airline", "Price", F.pmod(F.xxhash64("Airline", "Price", "__block"), F.lit(SALTS)).alias("__salt"),
            F.least(F.lit(_COPY_BLOCK), F.col("__copies") - F.col("__block") * _COPY_BLOCK).alias("__here"),
        )
        copied = recs.withColumn("__salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
        met = copied.join(dealt, ["userId", "__salt"])
        met = met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__here").cast("int"))))
        result = result.unionByName(met.drop("__salt", "__here", "__copy"))
    return result.withColumn("price_range", price_band("Price"))


def recommend_with_prices(
    model: ALSModel, labels: LabelIndex, fares: DataFrame, k: int = 10, lists: bool = True
) -> DataFrame:
    """The recommendation table: routes, fares of the user and price bands.

    ``lists`` repeats a user's whole list, and the entry as a struct, on each of its rows.
    """
    recs = recommendation_arrays(model, labels, k)
    return attach_fares(recs if lists else recs.select("userId", "ridx", "route"), fares)
