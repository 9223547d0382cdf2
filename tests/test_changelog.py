from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farewind import schemas
from farewind.operators import changelog, marks, trends
from farewind.operators.filters import facet_values
from farewind.scratch import folder_names, new_folder, passing_tables, shared_root, stored
from __spark_entry__ import SMOKE_DIR, queries
from tests.fixture_rows import FARE_ROWS, QUOTE_ROWS

START = datetime(2024, 9, 19, 12, 0, 0)
KEYS = schemas.QUOTE_KEYS


def fares(spark, rows):
    return spark.createDataFrame(rows, schemas.FARE)


def as_set(df):
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


# --- upsert ------------------------------------------------------------------------------


def test_upsert_into_empty_and_again(spark):
    empty, updates = fares(spark, []), fares(spark, FARE_ROWS)
    once = changelog.merge_upsert(empty, updates, schemas.FARE_KEYS)
    assert as_set(once) == set(FARE_ROWS)
    again = changelog.merge_upsert(once, updates, schemas.FARE_KEYS)
    assert as_set(again) == set(FARE_ROWS)
    assert once.columns == schemas.FARE.names


def test_upsert_changes_only_the_price(spark):
    target = fares(spark, FARE_ROWS)
    dearer = [(*row[:-1], row[-1] + 100) for row in FARE_ROWS[:2]]
    other = (*FARE_ROWS[0][:1], "2023-10-01", *FARE_ROWS[0][2:])
    source = fares(spark, [*dearer, other])
    merged = changelog.merge_upsert(target, source, schemas.FARE_KEYS)
    assert as_set(merged) == {*dearer, *FARE_ROWS[2:], other}
    changes = changelog.merge_changes(target, source, schemas.FARE_KEYS)
    assert as_set(changes) == {*((*row, "U") for row in dearer), (*other, "I")}


def test_upsert_with_null_values(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", None)], "k int, v string, p int")
    source = spark.createDataFrame([(1, None, None), (2, "c", 5)], "k int, v string, p int")
    merged = changelog.merge_upsert(target, source, ["k"])
    assert as_set(merged) == {(1, None, None), (2, "c", 5)}


def test_two_source_rows_for_a_target_row_are_an_error(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, p int")
    twice = spark.createDataFrame([(1, 11), (1, 12)], "k int, p int")
    with pytest.raises(Exception, match="more than one source row"):
        changelog.merge_upsert(target, twice, ["k"]).collect()
    with pytest.raises(Exception, match="more than one source row"):
        changelog.merge_changes(target, twice, ["k"]).collect()
    new = spark.createDataFrame([(3, 11), (3, 12)], "k int, p int")
    merged = changelog.merge_upsert(target, new, ["k"]).collect()
    assert sorted(map(tuple, merged)) == [(1, 10), (2, 20), (3, 11), (3, 12)]


def test_duplicates_are_found_before_any_column_is_read(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, p int")
    twice = spark.createDataFrame([(1, 11), (1, 12)], "k int, p int")
    for merge in (changelog.merge_upsert, changelog.merge_changes):
        with pytest.raises(ValueError, match="more than one source row"):
            merge(target, twice, ["k"]).count()
    largest = changelog.merge_upsert(target, twice, ["k"], on_duplicate="largest")
    assert as_set(largest) == {(1, 12), (2, 20)}
    with pytest.raises(ValueError, match="unknown choice"):
        changelog.merge_upsert(target, twice, ["k"], on_duplicate="guess")


def test_an_upsert_kept_by_row_loses_nothing(spark):
    """Keys that repeat and keys that are null: the log gives what the upsert gives."""
    fields = "a string, b string, p int"
    target = spark.createDataFrame([("x", None, 1), ("x", None, 2), ("k", "k", 5), ("k", "k", 6)], fields)
    source = spark.createDataFrame([("x", None, 9), ("n", "n", 7), ("n", "n", 8), ("k", "k", 50)], fields)
    expected = sorted(map(str, map(tuple, changelog.merge_upsert(target, source, ["a", "b"]).collect())))
    assert len(expected) == 8 - 1
    path = new_folder(spark, "row-log")
    schema = T.StructType([*target.schema.fields, T.StructField("_row_id", T.StringType()), *schemas.CHANGE_COLUMNS.fields])
    changelog.append_commit(target, path, 0, START, op="I", row_ids=True)
    state = changelog.as_of(changelog.read_changes(spark, path, schema), [changelog.ROW_ID])
    changes = changelog.merge_changes(state, source, ["a", "b"])
    assert sorted(r._op for r in changes.collect()) == ["I", "I", "I", "U", "U"]
    for _ in range(2):  # a retry replaces the commit
        changelog.append_commit(changes, path, 1, START + timedelta(hours=1))
    log = changelog.read_changes(spark, path, schema)
    after = changelog.as_of(log, [changelog.ROW_ID]).drop("_row_id")
    assert sorted(map(str, map(tuple, after.collect()))) == expected
    then = changelog.as_of(log, [changelog.ROW_ID], START).drop("_row_id")
    assert sorted(map(str, map(tuple, then.collect()))) == sorted(map(str, map(tuple, target.collect())))


def test_another_commit_of_the_same_number_is_an_error(spark):
    path = new_folder(spark, "quote-log")
    changelog.append_commit(quote_table(spark), path, 0, START, op="I")
    with pytest.raises(ValueError, match="another commit"):
        changelog.append_commit(quote_table(spark).limit(3), path, 0, START, op="I")
    changelog.append_commit(quote_table(spark), path, 1, START, op="U", token="a")
    with pytest.raises(ValueError, match="another commit"):
        changelog.append_commit(quote_table(spark), path, 1, START, op="U", token="b")
    assert changelog.read_changes(spark, path, schemas.QUOTE_CHANGES).count() == 48


def test_a_large_upsert_shuffles_its_target_once(spark, no_broadcast):
    no_broadcast()
    path = new_folder(spark, "upsert-target")
    spark.range(4000).select((F.col("id") % 900).alias("k"), F.lit("b").alias("b"), "id").write.parquet(path)
    target = spark.read.parquet(path)
    source = spark.range(600, 1200).select(F.col("id").alias("k"), F.lit("b").alias("b"), (-F.col("id")).alias("id"))
    source = source.union(source.filter("k >= 1100"))  # new keys may repeat
    merged = changelog.merge_upsert(target, source, ["k", "b"])
    text = merged._jdf.queryExecution().sparkPlan().toString()
    assert text.count("upsert-target") == 1 and text.count("FullOuter") == 1
    assert merged.count() == 4000 + 400 and merged.filter("id < 0").count() == merged.filter("k >= 600").count()


def test_a_crowded_key_is_spread_in_an_upsert(spark, no_broadcast):
    """A third of the rows has one key, and many of these are equal: no task gets them all."""
    no_broadcast()
    path = new_folder(spark, "crowded-target")
    crowd = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    spark.range(0, 30000, 1, 8).select(crowd.alias("k"), F.lit(1).alias("p")).write.parquet(path)
    target = spark.read.parquet(path)
    source = spark.range(-1, 10000).select(F.col("id").alias("k"), F.lit(2).alias("p"))
    merged = changelog.merge_upsert(target, source, ["k"])
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    sizes = merged.filter("k = -1").groupBy(F.spark_partition_id().alias("task")).count().collect()
    spark.conf.unset(name)
    assert sum(r["count"] for r in sizes) == 10000
    assert len(sizes) > 2 and max(r["count"] for r in sizes) <= 6000
    assert "crowded-keys" in merged._jdf.queryExecution().sparkPlan().toString()
    expected = 10000 + sum(1 for i in range(10000) if i % 3) + sum(1 for i in range(10000) if i % 3 == 0)
    assert merged.filter("p = 2").count() == expected
    assert [tuple(r) for r in merged.filter("k = -1").select("p").distinct().collect()] == [(2,)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("share", [None, 0.001, 0.2, 1.0])
def test_upsert_against_a_dictionary(spark, no_broadcast, monkeypatch, seed, share):
    """With a broadcast source, and with all, some or hardly any key taken for crowded."""
    if share is not None:
        no_broadcast()
        monkeypatch.setattr(changelog, "CROWDED_SHARE", share)
    chance = random.Random(seed)

    def key():
        return (chance.choice([1, 2, 3, None]), chance.choice(["a", "b", None]))

    target = [(*key(), chance.randrange(100)) for _ in range(40)]
    source, seen = [], set()
    for row in [(*key(), chance.randrange(100, 200)) for _ in range(10)]:
        if None in row or row[:2] not in seen:
            source.append(row)
            seen.add(row[:2])
    prices = {row[:2]: row[2] for row in source if None not in row[:2]}
    present = {row[:2] for row in target}
    expected = [(*row[:2], prices.get(row[:2], row[2])) for row in target]
    expected += [row for row in source if None in row[:2] or row[:2] not in present]
    frames = [spark.createDataFrame(rows, "a int, b string, p int") for rows in (target, source)]
    merged = changelog.merge_upsert(*frames, ["a", "b"]).collect()
    assert sorted(map(str, map(tuple, merged))) == sorted(map(str, expected))
    ops = changelog.merge_changes(*frames, ["a", "b"]).collect()
    assert sorted(str((r.a, r.b, r.p, r._op)) for r in ops) == sorted(
        str((*row, "U" if None not in row[:2] and row[:2] in present else "I")) for row in source
    )


# --- update ------------------------------------------------------------------------------


def _by_row(spark, rows):
    given = spark.createDataFrame(rows, "k int, m string, v int, w int")
    return given.withColumn(changelog.ROW_ID, F.concat(F.lit("0-"), F.monotonically_increasing_id().cast("string")))


@pytest.mark.parametrize("on_duplicate", ["error", "largest"])
def test_large_changes_by_row_read_the_keys_once(spark, no_broadcast, on_duplicate):
    rows = [(1, "a", 1, 0), (1, "a", 2, 0), (2, "b", 3, 0), (None, "a", 4, 0), (3, None, 5, 0)]
    target = _by_row(spark, rows)
    source = [(1, "a", 10, 1), (7, "z", 11, 1), (7, "z", 12, 2), (None, "a", 13, 3), (3, None, 14, 4)]
    if on_duplicate == "largest":
        source.append((1, "a", 9, 9))
    source = spark.createDataFrame(source, "k int, m string, v int, w int")
    plain = changelog.merge_changes(target, source, ["k", "m"], on_duplicate)
    want = sorted(map(str, plain.collect()))
    no_broadcast()
    large = changelog.merge_changes(target, source, ["k", "m"], on_duplicate)
    assert large.columns == plain.columns and sorted(map(str, large.collect())) == want
    assert large.filter("_op = 'U'").count() == 2 and large.filter("_op = 'I'").count() == 4
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    # the keys that both sides have were stored when called: the target is read for the updates alone
    assert plan.count("monotonically_increasing_id") == 1


def test_large_changes_by_row_refuse_repeats_and_match_keys_of_other_types(spark, no_broadcast):
    no_broadcast()
    target = _by_row(spark, [(1, "a", 1, 0), (2, "b", 2, 0)])
    twice = spark.createDataFrame([(1, "a", 5, 0), (1, "a", 6, 0)], "k int, m string, v int, w int")
    with pytest.raises(ValueError, match="more than one source row"):
        changelog.merge_changes(target, twice, ["k", "m"])
    wide = spark.createDataFrame([(1, "a", 5, 0), (9, "c", 6, 0)], "k long, m string, v int, w int")
    ops = {(row["k"], row["_op"]) for row in changelog.merge_changes(target, wide, ["k", "m"]).collect()}
    assert ops == {(1, "U"), (9, "I")}


def _log_by_row(spark):
    """Ids "0-0" to "0-999", of which every fiftieth is updated twice and every hundredth then deleted."""
    rows = [(f"0-{i}", i, 0, "I") for i in range(1000)]
    rows += [(f"0-{i}", -i - v, v, "U") for v in (1, 2) for i in range(0, 1000, 50)]
    rows += [(f"0-{i}", 0, 3, "D") for i in range(0, 1000, 100)]
    rows += [(None, 1, 0, "I"), (None, 2, 1, "U"), ("0-7", 70, 0, None)]
    log = spark.createDataFrame(rows, "_row_id string, p int, _version long, _op string")
    return log.withColumn("_commit_ts", F.timestamp_seconds("_version"))


@pytest.mark.parametrize("bits", [1 << 28, 1 << 12])
def test_a_state_by_row_shuffles_changed_rows_only(spark, monkeypatch, bits):
    monkeypatch.setattr(marks, "BITS", bits)  # a small set takes ids for others, and the state is the same
    log = _log_by_row(spark).filter("_op is not null")
    wanted = {i: -i - 2 if i % 50 == 0 else i for i in range(1000) if i % 100}
    for on_tie in ("any", "error"):
        state = changelog.as_of(log, [changelog.ROW_ID], on_tie=on_tie)
        assert state.columns == ["_row_id", "p"]
        assert as_set(state) == {(None, 2), *((f"0-{i}", p) for i, p in wanted.items())}
    old = changelog.as_of(log, [changelog.ROW_ID], 0, by="_version")
    assert as_set(old) == {(None, 1), *((f"0-{i}", i) for i in range(1000))}
    changed, alone = changelog._changed_rows(log)
    assert changed.count() + alone.count() == 1052
    assert changed.count() == 72 if bits == 1 << 28 else 72 <= changed.count() < 200
    # of the rows that never change none is in the grouping, and so in its shuffle
    assert {r._row_id for r in alone.collect()}.isdisjoint({f"0-{i}" for i in range(0, 1000, 50)})


def test_a_state_by_row_settles_unknown_kinds_and_ties_as_before(spark):
    log = _log_by_row(spark)
    ids = {r._row_id for r in changelog.as_of(log, [changelog.ROW_ID]).collect()}
    assert len(ids) in (990, 991) and ids - {"0-7"} == {None, *(f"0-{i}" for i in range(1000) if i % 100 and i != 7)}
    lone = spark.createDataFrame([("0-1", 1, None), ("0-2", 2, "I"), ("0-3", 3, "D")], "_row_id string, p int, _op string")
    lone = lone.withColumns({"_version": F.lit(0).cast("long"), "_commit_ts": F.timestamp_seconds(F.lit(0))})
    assert as_set(changelog.as_of(lone, [changelog.ROW_ID])) == {("0-2", 2)}
    with pytest.raises(Exception, match="two newest changes"):
        changelog.as_of(log, [changelog.ROW_ID], on_tie="error").collect()


@pytest.mark.parametrize("bits", [1 << 28, 64])
def test_large_changes_by_row_join_marked_rows_only(spark, no_broadcast, monkeypatch, bits):
    monkeypatch.setattr(marks, "BITS", bits)
    given = [(i % 300 or None, "m", i, 0) for i in range(600)]
    target = stored(_by_row(spark, given), "target")
    source = spark.createDataFrame([(i or None, "m", -i, 1) for i in range(290, 400)] + [(5000, "m", 1, 1)] * 3, "k int, m string, v int, w int")
    want = sorted(map(str, changelog.merge_changes(target, source, ["k", "m"]).collect()))
    no_broadcast()
    large = changelog.merge_changes(target, source, ["k", "m"])
    assert sorted(map(str, large.collect())) == want and len(want) == 20 + 103
    assert "__word0" in large._jdf.queryExecution().optimizedPlan().toString()


def test_a_set_of_bits_never_misses(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id")
    inside, outside = marks.split_by_bits(rows, F.col("h"), marks.bit_set(rows.filter("id % 5 = 0"), F.col("h")))
    ids = {r.id for r in inside.collect()}
    assert {i for i in range(0, 20_000, 5)} <= ids and len(ids) < 4100
    assert ids | {r.id for r in outside.collect()} == set(range(20_000)) and outside.count() + len(ids) == 20_000
    none, every = marks.split_by_bits(rows, F.col("h"), marks.bit_set(rows.limit(0), F.col("h")))
    assert none.count() == 0 and every.count() == 20_000
    assert marks.split_by_bits(rows.limit(0), F.col("h"), marks.bit_set(rows, F.col("h")))[0].count() == 0


def test_passing_tables_are_deleted(spark):
    kept = stored(spark.range(3), "kept")
    before = set(folder_names(spark, shared_root(spark)))
    with passing_tables():
        stored(spark.range(3), "passing")
        assert len(set(folder_names(spark, shared_root(spark))) - before) == 1
    assert set(folder_names(spark, shared_root(spark))) == before and kept.count() == 3
    with pytest.raises(ZeroDivisionError), passing_tables():
        stored(spark.range(3), "passing")
        1 / 0
    assert set(folder_names(spark, shared_root(spark))) == before


def test_an_upsert_through_the_log_leaves_no_copy_of_the_table(spark):
    before = set(folder_names(spark, shared_root(spark)))
    queries()["upsert_through_log"](spark, SMOKE_DIR)
    left = set(folder_names(spark, shared_root(spark))) - before
    assert sorted(name.rpartition("-")[0] for name in left) == ["note", "upsert-log"]


def test_a_fingerprint_is_the_sum_of_hashes_of_any_size(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as string) AS s")
    hashes = [r[0] for r in rows.select(F.xxhash64("id", "s")).collect()]
    xor = 0
    for value in hashes:
        xor ^= value
    assert changelog._fingerprint(rows, 0) == f"1000-{xor}-{sum(hashes)}"
    assert changelog._fingerprint(rows.limit(0), 0) == "0-None-None"


def test_a_commit_is_read_once_for_its_note_and_its_token(spark, monkeypatch):
    read = []
    monkeypatch.setattr(changelog, "_fingerprint", lambda *a: read.append(a))
    path = new_folder(spark, "log")
    rows = spark.range(10).withColumnRenamed("id", "k")
    changelog.append_commit(rows, path, 0, START, op="I")
    monkeypatch.undo()
    assert read == []
    changelog.append_commit(rows.orderBy(F.desc("k")), path, 0, START, op="I")  # its token is the same


def test_update_of_one_fare(spark):
    condition = "Airline = 'CheeseAir' AND Date_Of_Journey = '2023-09-01'"
    updated = changelog.update_where(fares(spark, FARE_ROWS), condition, {"Price": "5000"})
    assert as_set(updated) == {(*FARE_ROWS[0][:-1], 5000), *FARE_ROWS[1:]}
    assert updated.schema == schemas.FARE


def quote_table(spark):
    rows = [(START, *row) for row in QUOTE_ROWS]
    return spark.createDataFrame(rows, schemas.QUOTE)


def test_text_is_stored_as_decimal(spark):
    updated = changelog.update_where(
        quote_table(spark), "source = 'SEA' AND destination = 'TYO'", {"price": "'234'"}
    )
    prices = {(r.source, r.destination): r.price for r in updated.collect()}
    assert prices[("SEA", "TYO")] == Decimal("234.00")
    assert len(prices) == 24 and prices[("LAX", "LHR")] == Decimal("456.78")


def test_condition_that_is_null_updates_nothing(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, p int")
    assert as_set(changelog.update_where(df, "k = 'a'", {"p": "p * 10"})) == {(None, 1), ("a", 20)}


def test_assignments_read_old_values(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert as_set(changelog.update_where(df, "true", {"a": "b", "b": "a"})) == {(2, 1)}


def test_reprice_keeps_the_type(spark):
    moved = changelog.reprice(quote_table(spark), 10, at="2024-09-20 00:00:00")
    assert moved.schema["price"].dataType == schemas.QUOTE["price"].dataType
    before = {row[:3]: row[3] for row in QUOTE_ROWS}
    for row in moved.collect():
        key = (row.flight_departure, row.source, row.destination)
        assert row.price == before[key] + 10
        assert row.updatedTime == datetime(2024, 9, 20)


def test_reprice_overflow_is_an_error(spark):
    row = (START, "d", "s", "t", Decimal("99999999.99"))
    df = spark.createDataFrame([row], schemas.QUOTE)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        changelog.reprice(df, 10).collect()


# --- a table with a past -----------------------------------------------------------------


@pytest.fixture(scope="module")
def log(spark):
    """The quotes, one update, ten repricings an hour apart, and a deletion."""
    path = new_folder(spark, "quote-log")
    changelog.append_commit(quote_table(spark), path, 0, START, op="I")

    def current():
        return changelog.as_of(
            changelog.read_changes(spark, path, schemas.QUOTE_CHANGES), KEYS
        ).select(*schemas.QUOTE.names)

    update = changelog.update_changes(
        current(), "source = 'SEA' AND destination = 'TYO'", {"price": "'234'"}
    )
    changelog.append_commit(update, path, 1, START + timedelta(minutes=30))
    for hour in range(1, 11):
        at = START + timedelta(hours=hour)
        changelog.append_commit(changelog.reprice(current(), 10, at), path, 1 + hour, at, op="U")
    gone = current().filter("source = 'MIA'")
    changelog.append_commit(gone, path, 12, START + timedelta(hours=11), op="D")
    return changelog.read_changes(spark, path, schemas.QUOTE_CHANGES)


def price(df, source, destination):
    rows = df.filter((F.col("source") == source) & (F.col("destination") == destination))
    return [row.price for row in rows.collect()]


def test_states_of_the_past(log):
    def at(**after):
        return changelog.as_of(log, KEYS, START + timedelta(**after))

    assert at(seconds=-1).count() == 0
    assert price(at(), "SEA", "TYO") == [Decimal("123.45")]
    assert price(at(minutes=30), "SEA", "TYO") == [Decimal("234.00")]
    assert price(at(hours=3, minutes=59), "SEA", "TYO") == [Decimal("264.00")]
    assert at(hours=10).count() == 24
    assert at(hours=11).count() == 22
    assert price(changelog.as_of(log, KEYS), "MIA", "CHI") == []
    assert price(changelog.as_of(log, KEYS, 1, by="_version"), "SEA", "TYO") == [Decimal("234.00")]


def test_history(log):
    rows = {
        r.version: (r.rows_inserted, r.rows_updated, r.rows_deleted)
        for r in changelog.history(log).collect()
    }
    assert rows[0] == (24, 0, 0) and rows[1] == (0, 1, 0)
    assert all(rows[v] == (0, 24, 0) for v in range(2, 12)) and rows[12] == (0, 0, 2)
    first = changelog.history(log).where("timestamp = timestamp'2024-09-19 12:00:00'").collect()
    assert [row.version for row in first] == [0]


def test_a_finished_commit_is_never_written_again(spark):
    """A late retry, its rows in another order: a later commit's row ids still hold."""
    path = new_folder(spark, "row-log")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, p int").coalesce(1)
    schema = T.StructType([*rows.schema.fields, T.StructField("_row_id", T.StringType()), *schemas.CHANGE_COLUMNS.fields])
    changelog.append_commit(rows, path, 0, START, op="I", row_ids=True)
    state = changelog.as_of(changelog.read_changes(spark, path, schema), [changelog.ROW_ID])
    update = state.filter("k = 'a'").withColumns({"p": F.lit(50), "_op": F.lit("U")})
    changelog.append_commit(update, path, 1, START + timedelta(hours=1))
    changelog.append_commit(rows.orderBy(F.desc("k")), path, 0, START, op="I", row_ids=True)
    changelog.append_commit(update, path, 1, START + timedelta(hours=1))
    after = changelog.as_of(changelog.read_changes(spark, path, schema), [changelog.ROW_ID])
    assert sorted((r.k, r.p) for r in after.collect()) == [("a", 50), ("b", 2)]


def test_an_unfinished_commit_is_replaced_unless_a_later_one_exists(spark):
    path = new_folder(spark, "quote-log")
    changelog.append_commit(quote_table(spark), path, 0, START, op="I")
    # as a run leaves it that died before the note
    quote_table(spark).limit(3).selectExpr("*", "'U' AS _op", "now() AS _commit_ts").write.parquet(f"{path}/_version=1")
    changelog.append_commit(quote_table(spark).limit(5), path, 1, START, op="U")
    assert changelog.read_changes(spark, path, schemas.QUOTE_CHANGES).count() == 29
    quote_table(spark).limit(3).selectExpr("*", "'U' AS _op", "now() AS _commit_ts").write.parquet(f"{path}/_version=2")
    changelog.append_commit(quote_table(spark), path, 3, START, op="U", token="a")
    with pytest.raises(ValueError, match="after version 2"):
        changelog.append_commit(quote_table(spark), path, 2, START, op="U")
    assert changelog.commit_notes(spark, path).count() == 3


def test_notes_and_reads_by_them(spark, log):
    path = new_folder(spark, "imported-log")
    changelog.import_log(log, path)
    schema = schemas.QUOTE_CHANGES
    told = changelog.log_history(spark, path, check=schema)
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, changelog.history(log).collect()))
    assert {f.partition("_commits")[1] for f in told.inputFiles()} == {"_commits"}
    with pytest.raises(ValueError, match="another commit"):
        changelog.append_commit(quote_table(spark), path, 4, START, op="I")
    for hours in (-1, 0, 0.5, 3.9, 11):
        at = START + timedelta(hours=hours)
        found = changelog.read_state(spark, path, schema, KEYS, at)
        assert sorted(map(str, found.collect())) == sorted(map(str, changelog.as_of(log, KEYS, at).collect()))
    some = changelog.read_state(spark, path, schema, KEYS, START + timedelta(hours=1))
    assert {f.partition("_version=")[2].partition("/")[0] for f in some.inputFiles()} == {"0", "1", "2"}
    with pytest.raises(ValueError, match="later than"):
        changelog.append_baseline(spark, path, schema, KEYS, 13, START)
    changelog.append_baseline(spark, path, schema, KEYS, 13, START + timedelta(hours=12))
    now = changelog.read_state(spark, path, schema, KEYS)
    assert {f.partition("_version=")[2].partition("/")[0] for f in now.inputFiles()} == {"13"}
    assert sorted(map(str, now.collect())) == sorted(map(str, changelog.as_of(log, KEYS).collect()))
    then = changelog.read_state(spark, path, schema, KEYS, START + timedelta(hours=2))
    assert sorted(map(str, then.collect())) == sorted(map(str, changelog.as_of(log, KEYS, START + timedelta(hours=2)).collect()))


def test_notes_that_differ_from_the_data_are_found(spark, log):
    path = new_folder(spark, "imported-log")
    changelog.import_log(log, path)
    log.filter("_version = 12").drop("_version").write.mode("append").parquet(f"{path}/_version=12")
    with pytest.raises(ValueError, match="differ"):
        changelog.log_history(spark, path, check=schemas.QUOTE_CHANGES)


def test_an_empty_log_has_no_state(spark):
    path = new_folder(spark, "no-log")
    assert changelog.read_state(spark, path, schemas.QUOTE_CHANGES, KEYS).count() == 0


def test_repeating_a_commit_replaces_it(spark):
    path = new_folder(spark, "quote-log")
    for _ in range(2):
        changelog.append_commit(quote_table(spark), path, 0, START, op="I")
    assert changelog.read_changes(spark, path, schemas.QUOTE_CHANGES).count() == 24


def test_union_of_versions(log):
    both = changelog.union_versions(log, KEYS, [5, 0])
    assert both.groupBy("version").count().orderBy("version").collect() == [(0, 24), (5, 24)]
    assert sorted(price(both, "SEA", "TYO")) == [Decimal("123.45"), Decimal("274.00")]
    twice = changelog.union_versions(log, KEYS, [3, 3])
    assert twice.count() == 48


def test_time_frames_are_as_of_reads(spark, log):
    now = START + timedelta(hours=12)
    frames = changelog.compare_time_frames(log, KEYS, now).cache()
    assert {r.time_frame for r in frames.select("time_frame").distinct().collect()} == {
        "Current", *(f"{h}hrs Ago" for h in (1, 2, 3, 4, 6, 8, 10, 12))
    }
    for hours in changelog.LOOK_BACK_HOURS:
        then = changelog.as_of(log, KEYS, now - timedelta(hours=hours))
        tagged = frames.filter(F.col("time_frame") == f"{hours}hrs Ago").drop("time_frame")
        assert sorted(tagged.collect()) == sorted(then.collect())
    current = frames.filter("time_frame = 'Current'").drop("time_frame")
    assert sorted(current.collect()) == sorted(changelog.as_of(log, KEYS).collect())


def test_current_may_end_now(log):
    now = START + timedelta(hours=2)
    frames = changelog.compare_time_frames(log, KEYS, now, hours=[1], until_now=True)
    current = frames.filter("time_frame = 'Current'").drop("time_frame")
    assert sorted(current.collect()) == sorted(changelog.as_of(log, KEYS, now).collect())


def test_compacted_logs_read_the_same_later(spark, log):
    cut = START + timedelta(hours=4)
    short = changelog.compact(log, KEYS, cut)
    assert short.count() < log.count()
    for hours in (4, 5, 10, 11, 12):
        at = START + timedelta(hours=hours)
        assert sorted(changelog.as_of(short, KEYS, at).collect()) == sorted(changelog.as_of(log, KEYS, at).collect())


def test_current_includes_commits_after_now(log):
    frames = changelog.compare_time_frames(log, KEYS, START + timedelta(hours=2), hours=[1])
    assert sorted(price(frames, "SEA", "TYO")) == [Decimal("244.00"), Decimal("334.00")]


@pytest.mark.parametrize("seed", range(3))
def test_as_of_against_replay(spark, seed):
    chance = random.Random(seed)
    rows, state, past = [], {}, {}
    for version in range(30):
        at = START + timedelta(minutes=version // 2)
        for key in chance.sample("abcdef", 2):
            op = chance.choice("UUD")
            rows.append((key, chance.choice([None, version]), version, at, op))
            if op == "D":
                state.pop(key, None)
            else:
                state[key] = rows[-1][1]
        past[version] = dict(state)
    df = spark.createDataFrame(
        rows, "k string, v int, _version bigint, _commit_ts timestamp, _op string"
    ).repartition(4)
    marks = [(v, v) for v in range(30)]
    tagged = changelog.states_at(df, ["k"], marks, "at", by="_version").collect()
    for version, expected in past.items():
        assert {r.k: r.v for r in tagged if r["at"] == version} == expected
    for version in (0, 11, 29):
        got = changelog.as_of(df, ["k"], version, by="_version").collect()
        assert {r.k: r.v for r in got} == past[version]


def test_facets_cascade(log):
    current = changelog.as_of(log, KEYS)
    dates = facet_values(current, "flight_departure", source="SEA", destination="LAX")
    assert [row[0] for row in dates.collect()] == ["2024-09-29T03:00:00"]


def test_trend_of_a_steady_rise(log):
    frames = changelog.compare_time_frames(log, KEYS, START + timedelta(hours=12))
    route = frames.filter("source = 'SEA' AND destination = 'LAX'").distinct()
    line = trends.price_trend(route.withColumn("all", F.lit(1)), by=["all"]).first()
    assert line.slope == pytest.approx(10 / 3600)
    assert line.r2 == pytest.approx(1.0)
    bars = trends.price_bars(frames).filter("time_frame = '12hrs Ago'").collect()
    assert [row.price for row in bars] == [sum(row[3] for row in QUOTE_ROWS)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_trend_of_zoneless_times_in_any_session_zone(spark, zone):
    # Twelve-hour steps across the day New York changes its clocks.
    rows = [(f"2024-03-{9 + i // 2:02d} {12 * (i % 2):02d}:00:00", 5.0 * i) for i in range(6)]
    df = spark.createDataFrame(rows, "at string, price double").selectExpr(
        "1 AS time_frame", "price", "cast(at AS timestamp_ntz) AS updatedTime"
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        line = trends.price_trend(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert line.slope == pytest.approx(5 / 43200, rel=1e-12)
    assert line.n == 6


def test_differing_newest_changes_can_be_an_error(spark):
    fields = "k int, p int, _version long, _commit_ts timestamp, _op string"
    rows = [(1, 5, 0, START, "I"), (1, 5, 0, START, "I"), (2, 6, 0, START, "I"), (2, 7, 1, START, "U"), (3, 1, 1, START, "D")]
    log = spark.createDataFrame(rows, fields)
    assert as_set(changelog.as_of(log, ["k"], on_tie="error")) == {(1, 5), (2, 7)}
    tied = log.union(spark.createDataFrame([(2, 8, 1, START, "U")], fields))
    assert {r.k for r in changelog.as_of(tied, ["k"]).collect()} == {1, 2}
    with pytest.raises(Exception, match="two newest changes"):
        changelog.as_of(tied, ["k"], on_tie="error").collect()
    with pytest.raises(ValueError, match="unknown choice"):
        changelog.as_of(log, ["k"], on_tie="guess")
