"""Tables with a past, kept as a change log.

A change log is an ordinary append-only table: the columns of the table plus ``_version``
(number of the commit), ``_commit_ts`` (its time) and ``_op`` (``I`` inserted, ``U`` updated,
``D`` deleted). The state at any time is an aggregate over it. One writer at a time numbers
the commits; a key occurs at most once in a commit unless ``order`` says how to break ties.

Tables without a unique key are kept by row: ``append_commit`` gives every inserted row a
``_row_id``, update and delete rows carry the id of the row they replace, and the id is the
key (``keys=[ROW_ID]``) of every read. Nothing is lost then, whatever keys repeat or are null.

A finished commit has a note (its token, times and numbers of rows). Histories are read from the
notes alone, and states from the folders that the notes say can matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from farewind.operators.marks import bit_set, split_by_bits
from farewind.scratch import fits_broadcast, folder_names, move_folder, path_exists, stored

ROW_ID = "_row_id"

CHANGE_ORDER = ("_commit_ts", "_version")
_LOG_COLUMNS = ("_version", "_commit_ts", "_op")
_ROWS_OF = {"I": "rows_inserted", "U": "rows_updated", "D": "rows_deleted"}
_NOTE_COLUMNS = ["first_ts", "last_ts", *_ROWS_OF.values()]
_NOTE_SCHEMA = "version long, kind string, token string, first_ts timestamp, last_ts timestamp, " + ", ".join(
    f"{name} long" for name in _ROWS_OF.values()
)
# Of a commit's fingerprint: its aggregates, and the bits of a hash in the lower parts of their sum.
_MARKS, _PART_BITS = ("__n", "__xor", "__high", "__middle", "__low"), 21
# Folders of a log that readers skip: notes of finished commits, and rows not yet moved into it.
_NOTES, _APART = "_commits", "_apart"

#: A key with more than this share of a target's rows is crowded (a thousand keys at most are).
CROWDED_SHARE = 0.001

_REPEATED = "more than one source row matches a target row"

# The look-back periods, in hours, of the price comparison.
LOOK_BACK_HOURS = (1, 2, 3, 4, 6, 8, 10, 12, 14, 16, 18, 20)


# --- writing -----------------------------------------------------------------------------


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error"
) -> DataFrame:
    """The target after an upsert: matching rows take the source's values, others are added.

    Keys compare with ``=``: a row with a null key matches nothing, so it stays (target) or
    is added (source). Source rows that repeat a key are added like others when no target row
    has it. When one has, that is an error, raised here; with ``on_duplicate="largest"`` the
    source row with the largest values is taken instead.

    Runs jobs when called: the source is stored, because it is used several times, and its
    repeated keys are looked for. The target is read twice (keys only, then all columns) and
    shuffled once, or not at all if the source is broadcast.
    """
    source, repeats = _ready(target, source, keys, on_duplicate)
    values = [name for name in target.columns if name not in keys]
    settled = on_duplicate == "error" or not repeats  # what repeats matches nothing
    if settled and not fits_broadcast(source):
        return _upsert_at_once(target, source, keys, values)
    hit = F.col("__hit").isNotNull()
    updated = (
        _spread(target, keys)
        .join(_one_per_key(source, keys, values), [*keys, "__spread"], "left")
        .select(
            *[
                F.col(name)
                if name in keys
                else F.when(hit, F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name)
                for name in target.columns
            ]
        )
    )
    return updated.unionByName(_added(target, source, keys).select(*target.columns))


def merge_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error"
) -> DataFrame:
    """Only the rows an upsert would write, with ``_op`` ``U`` (matched) or ``I`` (added).

    If the target has a ``_row_id``, there is one ``U`` row for every target row that matches,
    with its id, and added rows have none yet. Otherwise there is one row per source row.
    Errors and jobs as in ``merge_upsert``; of a source too large to broadcast the keys that both
    sides have are stored too.
    """
    if ROW_ID in target.columns and not fits_broadcast(source):
        return _changes_by_row(target, source, keys, on_duplicate)
    source, _ = _ready(target, source, keys, on_duplicate)
    if ROW_ID not in target.columns:
        matched = _matched_keys(target, source, keys).withColumn("__hit", F.lit(True))
        keyed = source.filter(_no_nulls(keys)).join(matched, list(keys), "left")
        op = F.when(F.col("__hit").isNotNull(), F.lit("U")).otherwise(F.lit("I"))
        unkeyed = source.filter(~_no_nulls(keys)).withColumn("_op", F.lit("I"))
        columns = [*target.columns, "_op"]
        return keyed.withColumn("_op", op).select(*columns).unionByName(unkeyed.select(*columns))
    values = _row_values(target, keys)
    once = _one_per_key(source, keys, values).drop("__spread")
    replaced = target.filter(_no_nulls(keys)).join(once, list(keys))
    return _row_changes(target, replaced, values, _added(target, source, keys))


def _row_values(target: DataFrame, keys: Sequence[str]) -> list[str]:
    return [name for name in target.columns if name not in (*keys, ROW_ID)]


def _row_changes(target: DataFrame, replaced: DataFrame, values: Sequence[str], added: DataFrame) -> DataFrame:
    updates = replaced.select(
        *[F.col(f"__new_{name}").alias(name) if name in values else F.col(name) for name in target.columns],
        F.lit("U").alias("_op"),
    )
    no_id = F.lit(None).cast(target.schema[ROW_ID].dataType)
    inserts = added.withColumns({ROW_ID: no_id, "_op": F.lit("I")})
    return updates.unionByName(inserts.select(*updates.columns))


def _changes_by_row(target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str) -> DataFrame:
    """Changes of a target with row ids by a large source, the target read twice (keys; keys and ids).

    The keys that both sides have are stored, with their numbers of source rows: they tell what
    repeats and what is added. Rows are joined by a hash of the keys first, by which they are sorted quickly.
    Only rows whose hash has its bit among those of the other side's keys are shuffled.
    """
    _check_choice(on_duplicate)
    hashed = _key_hash(target, source, keys)
    rows = stored(source, "upsert-source")
    full = rows.filter(_no_nulls(keys)).withColumn("__hash", hashed)
    by = ["__hash", *keys]
    counted = full.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    keyed, marked = target.filter(_no_nulls(keys)).withColumn("__hash", hashed), F.col("__hash")
    wanted, _ = split_by_bits(keyed, marked, bit_set(full, marked))
    matched = stored(wanted.select(*by).distinct().join(counted, by).select(*counted.columns), "matched-keys")
    if on_duplicate == "error" and not matched.filter("__rows > 1").isEmpty():
        raise ValueError(_REPEATED)
    values = _row_values(target, keys)
    bits = bit_set(matched, marked)
    wanted, _ = split_by_bits(keyed.select(*by, ROW_ID), marked, bits)
    met, fresh = split_by_bits(full, marked, bits)
    if on_duplicate == "error":  # what repeats matches nothing
        new = met.select(*by, *[F.col(name).alias(f"__new_{name}") for name in values])
    else:
        new = _one_per_key(met, by, values).drop("__spread")
    replaced = wanted.join(new, by)
    added = fresh.unionByName(met.join(matched, by, "left_anti")).drop("__hash")
    return _row_changes(target, replaced, values, added.unionByName(rows.filter(~_no_nulls(keys))))


def _key_hash(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of the keys, or nothing but zero if their types differ: equal keys might hash apart."""
    alike = all(target.schema[name].dataType == source.schema[name].dataType for name in keys)
    return F.xxhash64(*keys) if alike else F.lit(0).cast("long")


def _upsert_at_once(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """An upsert by one full outer join, for a source whose keys match the target once at most.

    A full outer join cannot be split at run time, so crowded keys do not take part: their rows are
    updated where they are read, from the few source rows they match, and pass the join spread
    over its tasks. All crowded keys are in the target, so no source row of theirs is added. The
    first join key is a hash of all keys, by which rows are sorted quickly.
    """
    hashed = F.xxhash64(*keys).alias("__hash")
    crowded = _crowded_keys(target, keys)
    new = source.filter(_no_nulls(keys)).select(
        hashed, *keys, F.lit(True).alias("__hit"), *[F.col(name).alias(f"__new_{name}") for name in values]
    )
    told = new.drop("__hash").join(F.broadcast(crowded), list(keys), "left_semi")
    others = new.join(F.broadcast(crowded), list(keys), "left_anti").withColumn("__spread", _at_home(keys))

    def settled(rows: DataFrame, *more: Column) -> DataFrame:
        hit = F.col("__hit").isNotNull()
        picked = [
            F.when(hit, F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name) if name in values else F.col(name)
            for name in target.columns
        ]
        return rows.select(*picked, *more)

    marked = target.join(F.broadcast(crowded.withColumn("__crowded", F.lit(True))), list(keys), "left")
    marked = settled(marked.join(F.broadcast(told), list(keys), "left"), F.col("__crowded"))
    alone = ~_no_nulls(keys) | F.col("__crowded").isNotNull()
    spread = F.when(alone, _apart(target.columns)).otherwise(0)
    own = marked.select(hashed, *target.columns, spread.alias("__spread"))
    merged = settled(own.join(others, ["__hash", *keys, "__spread"], "full"))
    return merged.unionByName(source.filter(~_no_nulls(keys)).select(*target.columns))


def _crowded_keys(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full keys of the target, among them all with more than CROWDED_SHARE of its rows.

    Counters bounded by that share are merged from task to task: a thousand keys at most.
    """
    full = target.filter(_no_nulls(keys)).select(F.struct(*keys).alias("key"))
    found = full.stat.freqItems(["key"], CROWDED_SHARE).select(F.explode("key_freqItems").alias("key"))
    return stored(found.select("key.*").distinct(), "crowded-keys")


def _ready(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str
) -> tuple[DataFrame, bool]:
    """The source, stored, and whether full keys repeat in it.

    Repeated keys that match a target row are an error, or settled later.
    """
    _check_choice(on_duplicate)
    rows = stored(source, "upsert-source")
    repeated = rows.filter(_no_nulls(keys)).groupBy(*keys).count().filter("count > 1").select(*keys)
    repeats = not repeated.isEmpty()
    if repeats and on_duplicate == "error" and not target.join(repeated, list(keys), "left_semi").isEmpty():
        raise ValueError(_REPEATED)
    return rows, repeats


def _check_choice(on_duplicate: str) -> None:
    if on_duplicate not in ("error", "largest"):
        raise ValueError(f"unknown choice for duplicates: {on_duplicate}")


def _no_nulls(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in keys])


def _spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a full key would all meet in one task of a shuffled join."""
    return rows.withColumn("__spread", F.when(_no_nulls(keys), F.lit(0)).otherwise(_apart(rows.columns)))


def _at_home(keys: Sequence[str]) -> Column:
    """Zero, in a form that is not folded: a constant would drop out of the join's keys."""
    return F.hash(*keys).bitwiseAND(F.lit(0))


def _apart(columns: Sequence[str]) -> Column:
    """A number from 1 to 1000, fixed by the row and the task that reads it; copies differ by task."""
    return 1 + F.abs(F.hash(*columns, F.spark_partition_id()) % 1000)


def _one_per_key(source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Each full key of the source once, with its (largest) values under new names."""
    largest = F.max(F.struct(F.lit(True).alias("hit"), *values)).alias("__row")
    once = source.filter(_no_nulls(keys)).groupBy(*keys).agg(largest)
    return once.select(
        *keys,
        F.col("__row.hit").alias("__hit"),
        *[F.col(f"__row.{name}").alias(f"__new_{name}") for name in values],
        _at_home(keys).alias("__spread"),
    )


def _matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present on both sides, each once.

    A source that Spark will broadcast thins out the target first. Otherwise the target's keys
    are made distinct before the join, so that a crowded key is combined where it is read and
    never meets in one task.
    """
    wanted = source.filter(_no_nulls(keys)).select(*keys).distinct()
    own = target.select(*keys)
    if fits_broadcast(source):
        return own.join(wanted, list(keys), "left_semi").distinct()
    return own.distinct().join(wanted, list(keys), "left_semi")


def _added(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that match nothing; those without a full key do not go through the join."""
    keyed = source.filter(_no_nulls(keys)).join(
        _matched_keys(target, source, keys), list(keys), "left_anti"
    )
    return keyed.unionByName(source.filter(~_no_nulls(keys)))


def update_where(
    df: DataFrame, condition: Column | str, assign: Mapping[str, Column | str]
) -> DataFrame:
    """All rows, with expressions assigned to columns where the condition is true.

    Every expression reads the old row, and is cast to the type of its column.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition
    new = _assignments(df, assign)
    return df.withColumns(
        {name: F.when(test, value).otherwise(F.col(name)) for name, value in new.items()}
    )


def update_changes(
    df: DataFrame, condition: Column | str, assign: Mapping[str, Column | str]
) -> DataFrame:
    """Only the rows an update would write, with ``_op`` ``U``."""
    return df.filter(condition).withColumns(_assignments(df, assign)).withColumn("_op", F.lit("U"))


def _assignments(df: DataFrame, assign: Mapping[str, Column | str]) -> dict[str, Column]:
    return {
        name: (F.expr(value) if isinstance(value, str) else value).cast(df.schema[name].dataType)
        for name, value in assign.items()
    }


def reprice(
    df: DataFrame,
    delta: Any,
    at: Column | str | datetime | None = None,
    price: str = "price",
    stamp: str = "updatedTime",
) -> DataFrame:
    """Every price moved by ``delta`` in its own type, and the row stamped (default: now)."""
    when = F.current_timestamp() if at is None else moment(at)
    moved = F.col(price) + (delta if isinstance(delta, Column) else F.lit(delta))
    return df.withColumns(
        {
            price: moved.cast(df.schema[price].dataType),
            stamp: when.cast(df.schema[stamp].dataType),
        }
    )


def append_commit(
    rows: DataFrame,
    path: str,
    version: int,
    at: Column | str | datetime,
    op: str | None = None,
    token: str | None = None,
    row_ids: bool = False,
    kind: str = "commit",
) -> None:
    """Write rows as commit ``version`` of the change log at ``path``.

    The rows are computed once, into a folder apart; that folder is then moved into the log, and a
    note with the commit's token, times and numbers of rows is written. A commit with a note is
    finished: repeating it writes nothing, so its row ids stay, and a commit with another token
    is an error. Without a note it is replaced, unless a later commit exists, which is an error.
    ``token`` is a fingerprint of the rows by default, whatever their order. ``op`` is for rows
    without their own ``_op``. With ``row_ids``, or if the rows have a ``_row_id``, rows without
    an id get one from the version and their place, fixed by being written.
    """
    spark, version = rows.sparkSession, int(version)
    if op is not None:
        rows = rows.withColumn("_op", F.lit(op))
    noted = _noted_token(spark, path, version)
    if noted is not None:
        if noted != (token or _fingerprint(rows, version)):
            raise ValueError(f"version {version} is another commit")
        return
    if any(other > version for other in _versions(spark, path)):
        raise ValueError(f"a commit after version {version} exists")
    if row_ids or ROW_ID in rows.columns:
        known = F.col(ROW_ID) if ROW_ID in rows.columns else F.lit(None).cast("string")
        fresh = F.concat(F.lit(f"{version}-"), F.monotonically_increasing_id().cast("string"))
        rows = rows.withColumn(ROW_ID, F.coalesce(known, fresh))
    stamped = rows.withColumn("_commit_ts", moment(at).cast("timestamp"))
    apart = f"{path}/{_APART}/{version}-{uuid.uuid4().hex}"
    stamped.write.parquet(apart)
    written = spark.read.schema(stamped.schema).parquet(apart)
    marks = [] if token else _fingerprint_parts(written, version)
    # one pass over what was written, for the note and the token
    noted = stored(written.agg(*_summary(), *marks), "note")
    token = token or _joined_fingerprint(noted.first())
    note = noted.select(
        F.lit(version).cast("long").alias("version"), F.lit(kind).alias("kind"), F.lit(token).alias("token"), *_NOTE_COLUMNS
    )
    move_folder(spark, apart, f"{path}/_version={version}")
    note.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_NOTES}/{version}")


def import_log(changes: DataFrame, path: str) -> None:
    """Write changes that have ``_version``, ``_commit_ts`` and ``_op`` as a new log, with its notes.

    One pass over the rows and one over three columns of what was written; a crowded commit is
    written by several tasks.
    """
    spark = changes.sparkSession
    if _versions(spark, path):
        raise ValueError(f"there is a log at {path}")
    changes.hint("rebalance", "_version").write.partitionBy("_version").parquet(path)
    kinds = T.StructType([changes.schema[name] for name in _LOG_COLUMNS])
    notes = read_changes(spark, path, kinds).groupBy(F.col("_version").cast("long").alias("version")).agg(*_summary())
    notes = notes.select("version", F.lit("commit").alias("kind"), F.lit(None).cast("string").alias("token"), *_NOTE_COLUMNS)
    notes.coalesce(1).write.parquet(f"{path}/{_NOTES}/imported")


def append_baseline(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    version: int,
    at: Column | str | datetime,
    order: Sequence[str] = CHANGE_ORDER,
) -> None:
    """A commit that holds the whole state, so that later reads by the notes may begin there.

    ``at`` must not lie before any commit, or states in between would read wrongly.
    """
    late = commit_notes(spark, path).filter(F.col("last_ts") > moment(at).cast("timestamp"))
    if not late.isEmpty():
        raise ValueError("a commit is later than the baseline")
    state = as_of(read_changes(spark, path, schema), keys, order=order)
    append_commit(state, path, version, at, op="I", token=f"baseline {version}", kind="baseline")


def commit_notes(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished commit: version, kind, token, first_ts, last_ts and rows by kind."""
    if not folder_names(spark, f"{path}/{_NOTES}"):
        return spark.createDataFrame([], _NOTE_SCHEMA)
    return spark.read.schema(_NOTE_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{path}/{_NOTES}")


def _summary() -> list[Column]:
    counts = [F.count_if(F.col("_op") == op).alias(name) for op, name in _ROWS_OF.items()]
    return [F.min("_commit_ts").alias("first_ts"), F.max("_commit_ts").alias("last_ts"), *counts]


def _fingerprint(rows: DataFrame, version: int) -> str:
    """Of the rows in any order, without the ids that this commit deals and its time."""
    return _joined_fingerprint(rows.agg(*_fingerprint_parts(rows, version)).first())


def _fingerprint_parts(rows: DataFrame, version: int) -> list[Column]:
    """Aggregates of the rows' hashes: their number, exclusive or, and sum.

    The sum is kept in three parts of at most 22 bits a row, which long numbers hold for 10^12 rows.
    """
    columns = [F.col(f"`{name}`") for name in sorted(rows.columns) if name not in (ROW_ID, "_commit_ts")]
    if ROW_ID in rows.columns:
        columns.append(F.when(~F.col(ROW_ID).startswith(f"{version}-"), F.col(ROW_ID)))
    hashed, low = F.xxhash64(*columns), F.lit((1 << _PART_BITS) - 1)
    parts = [
        F.shiftright(hashed, 2 * _PART_BITS), F.shiftright(hashed, _PART_BITS).bitwiseAND(low), hashed.bitwiseAND(low)
    ]
    marks = [F.count(F.lit(1)), F.bit_xor(hashed), *map(F.sum, parts)]
    return [mark.alias(name) for mark, name in zip(marks, _MARKS)]


def _joined_fingerprint(row: Row) -> str:
    n, xor, high, middle, low = (row[name] for name in _MARKS)
    total = ((high << _PART_BITS) + middle << _PART_BITS) + low if n else None
    return f"{n}-{xor}-{total}"


def _noted_token(spark: SparkSession, path: str, version: int) -> str | None:
    """The token of a finished commit; a commit of an imported log has an empty one."""
    notes = folder_names(spark, f"{path}/{_NOTES}")
    if str(version) in notes:
        if not path_exists(spark, f"{path}/{_NOTES}/{version}/_SUCCESS"):
            return None
        return spark.read.schema(_NOTE_SCHEMA).parquet(f"{path}/{_NOTES}/{version}").first()["token"]
    if "imported" in notes:
        imported = spark.read.schema(_NOTE_SCHEMA).parquet(f"{path}/{_NOTES}/imported")
        return None if imported.filter(F.col("version") == version).isEmpty() else ""
    return None


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = folder_names(spark, path)
    return [int(name.partition("=")[2]) for name in names if name.startswith("_version=")]


def compact(changes: DataFrame, keys: Sequence[str], keep_after: Column | str | datetime, order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """The log with all changes up to a time replaced by the rows they had led to.

    States from then on read the same from the result, which is as long as the table plus the
    later changes. Store it as another log; a baseline row keeps its last change's columns.
    """
    cutoff = _cutoff(changes, "_commit_ts", keep_after)
    rest = [name for name in changes.columns if name not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    baseline = changes.filter(F.col("_commit_ts") <= cutoff).groupBy(*keys).agg(newest)
    baseline = baseline.filter(F.col("__row._op") != "D").select(
        *[F.col(name) if name in keys else F.col(f"__row.{name}").alias(name) for name in changes.columns]
    )
    return baseline.unionByName(changes.filter(F.col("_commit_ts") > cutoff))


def read_changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The change log at ``path``; ``schema`` includes the log columns."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# --- reading -----------------------------------------------------------------------------


def as_of(
    changes: DataFrame,
    keys: Sequence[str],
    at: Column | str | datetime | int | None = None,
    order: Sequence[str] = CHANGE_ORDER,
    by: str = "_commit_ts",
    on_tie: str = "any",
) -> DataFrame:
    """The table as it was at a time (or, with ``by="_version"``, a version); default: now.

    Empty before the first commit. One shuffle, of one row per key and map task. Where the newest
    changes of a key are equal in ``order`` but differ, any of them is taken, or with
    ``on_tie="error"`` that is an error when rows are read.

    Of a table kept by row (``keys=[ROW_ID]``) most rows never change. The hashes of its ids are counted
    first, and only rows whose id may occur more than once are shuffled; the log is read three times.
    """
    if on_tie not in ("any", "error"):
        raise ValueError(f"unknown choice for ties: {on_tie}")
    values = _value_columns(changes, keys)
    seen = changes if at is None else changes.filter(F.col(by) <= _cutoff(changes, by, at))
    by_row = list(keys) == [ROW_ID] and changes.schema[ROW_ID].dataType == T.StringType()
    if by_row:
        seen, alone = _changed_rows(seen)
    newest = F.max_by(F.struct(*values, "_op"), F.struct(*order)).alias("__row")
    stays = F.col("__row._op") != "D"
    if on_tie == "any":
        rows = seen.groupBy(*keys).agg(newest).filter(stays)
    else:
        # the largest and the smallest hash among the changes that come last
        content = F.xxhash64(*values, "_op")
        high, low = (F.max(F.struct(*order, h.alias("__content"))) for h in (content, F.bitwise_not(content)))
        rows = seen.groupBy(*keys).agg(newest, high.alias("__high"), low.alias("__low"))
        tie = F.col("__high.__content") != F.bitwise_not(F.col("__low.__content"))
        told = F.raise_error(F.lit("two newest changes of a key differ")).cast("boolean")
        rows = rows.filter(F.when(tie, told).otherwise(stays))
    state = rows.select(*_in_table_order(changes, keys, values))
    return alone.filter("_op <> 'D'").select(*state.columns).unionByName(state) if by_row else state


def _changed_rows(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes by row whose id may occur more than once, and those that are known to be alone."""
    hashed = F.xxhash64(ROW_ID)
    repeated = changes.groupBy(hashed.alias("__hash")).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    return split_by_bits(changes, hashed, bit_set(repeated, F.col("__hash")))


def read_state(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    at: Column | str | datetime | None = None,
    order: Sequence[str] = CHANGE_ORDER,
) -> DataFrame:
    """``as_of`` of the log at ``path``, listing only the commits that can matter.

    The notes tell which commits began after ``at``, and the newest baseline that was complete by
    then: folders of the former, and of all before the latter, are not even listed. The driver
    gets one number per commit since the baseline. Only finished commits are read.
    """
    notes = commit_notes(spark, path)
    if at is not None:
        notes = notes.filter(F.col("first_ts") <= moment(at).cast("timestamp"))
    whole = F.col("kind") == "baseline"
    if at is not None:
        whole = whole & (F.col("last_ts") <= moment(at).cast("timestamp"))
    begin = notes.filter(whole).agg(F.max("version")).first()[0]
    wanted = notes if begin is None else notes.filter(F.col("version") >= begin)
    folders = [f"{path}/_version={row['version']}" for row in wanted.select("version").distinct().collect()]
    if not folders:
        return as_of(spark.createDataFrame([], schema), keys, at, order)
    changes = spark.read.schema(schema).option("basePath", path).parquet(*sorted(folders))
    return as_of(changes.select(*schema.names), keys, at, order)


def states_at(
    changes: DataFrame,
    keys: Sequence[str],
    marks: Sequence[tuple[Any, Any]],
    tag: str,
    order: Sequence[str] = CHANGE_ORDER,
    by: str = "_commit_ts",
) -> DataFrame:
    """The union of the table's states at several marks, each row tagged with its mark's label.

    ``marks`` are (label, cutoff) pairs, earliest cutoff first; a last cutoff of None means the
    current state. The log is read once: every change falls between two neighbouring cutoffs,
    the newest change of each key and interval survives, and a surviving row is valid from its
    own cutoff up to the key's next surviving row. Only the first step shuffles log rows, and
    those are reduced to one per key and interval beforehand.
    """
    values = _value_columns(changes, keys)
    labels = [label for label, _ in marks]
    closed = [_cutoff(changes, by, end) for _, end in marks if end is not None]

    slot = reduce(
        lambda a, b: a + b, [(F.col(by) > bound).cast("int") for bound in closed], F.lit(0)
    )
    seen = changes if len(closed) < len(marks) else changes.filter(F.col(by) <= closed[-1])
    newest = F.max_by(F.struct(*values, "_op"), F.struct(*order)).alias("__row")
    kept = seen.groupBy(*keys, slot.alias("__slot")).agg(newest)
    kept = kept.select(
        *_in_table_order(changes, keys, values), "__slot", F.col("__row._op").alias("__op")
    )

    later = Window.partitionBy(*keys).orderBy("__slot")
    until = F.lead("__slot", 1, len(marks)).over(later)
    valid = kept.withColumn("__until", until).filter(F.col("__op") != "D")
    names = F.array(*[F.lit(label) for label in labels])
    held = F.slice(names, F.col("__slot") + 1, F.col("__until") - F.col("__slot"))
    return valid.withColumn(tag, F.explode(held)).drop("__slot", "__until", "__op")


def compare_time_frames(
    changes: DataFrame,
    keys: Sequence[str],
    now: Column | str | datetime,
    hours: Sequence[int] = LOOK_BACK_HOURS,
    order: Sequence[str] = CHANGE_ORDER,
    until_now: bool = False,
) -> DataFrame:
    """Current rows next to the rows of some hours ago, tagged in ``time_frame``.

    ``Current`` is the newest state, or with ``until_now`` the state at ``now``.

    Filter the log by key columns beforehand to compare one connection.
    """
    start = _cutoff(changes, "_commit_ts", now)
    marks = [
        (f"{back}hrs Ago", start - F.make_dt_interval(hours=F.lit(back)))
        for back in sorted(hours, reverse=True)
    ]
    return states_at(changes, keys, [*marks, ("Current", start if until_now else None)], "time_frame", order)


def union_versions(
    changes: DataFrame,
    keys: Sequence[str],
    versions: Sequence[int],
    order: Sequence[str] = CHANGE_ORDER,
) -> DataFrame:
    """Rows of several versions together, duplicates kept, tagged in ``version``."""
    marks = [(version, version) for version in sorted(versions)]
    tagged = states_at(changes, keys, marks, "version", order, by="_version")
    return tagged.withColumn("version", F.col("version").cast("bigint"))


def union_tables(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of two stored copies together, matched by position, duplicates kept."""
    return first.union(second)


def history(changes: DataFrame) -> DataFrame:
    """One row per commit: version, time, and how many rows it wrote of each kind."""

    def rows(op: str) -> Column:
        return F.count_if(F.col("_op") == op)

    return changes.groupBy(F.col("_version").alias("version")).agg(
        F.max("_commit_ts").alias("timestamp"),
        rows("I").alias("rows_inserted"),
        rows("U").alias("rows_updated"),
        rows("D").alias("rows_deleted"),
    )


def log_history(spark: SparkSession, path: str, check: T.StructType | None = None) -> DataFrame:
    """``history`` of the log at ``path`` from the notes of its commits, without reading its data.

    ``check`` is the log's schema, if the notes are to be compared with the data: a difference is
    an error, raised here.
    """
    told = commit_notes(spark, path).select("version", F.col("last_ts").alias("timestamp"), *_ROWS_OF.values())
    if check is not None:
        counted = history(read_changes(spark, path, check)).withColumn("version", F.col("version").cast("long"))
        wrong = told.exceptAll(counted).unionByName(counted.exceptAll(told))
        if not wrong.isEmpty():
            raise ValueError("the notes differ from the data")
    return told


def moment(at: Column | str | datetime) -> Column:
    """A time given as a column, text or Python value."""
    if isinstance(at, Column):
        return at
    return F.lit(at) if isinstance(at, str) else F.lit(at.isoformat(sep=" "))


def _cutoff(changes: DataFrame, by: str, at: Any) -> Column:
    value = F.lit(at) if isinstance(at, int) else moment(at)
    return value.cast(changes.schema[by].dataType)


def _value_columns(changes: DataFrame, keys: Sequence[str]) -> list[str]:
    return [name for name in changes.columns if name not in (*keys, *_LOG_COLUMNS)]


def _in_table_order(
    changes: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> list[Column]:
    return [
        F.col(name) if name in keys else F.col(f"__row.{name}").alias(name)
        for name in changes.columns
        if name in keys or name in values
    ]
