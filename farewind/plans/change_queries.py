"""Upserts, updates, states of the past, and price comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farewind.operators import changelog, trends
from farewind.operators.changelog import LOOK_BACK_HOURS
from farewind.plans.bindings import (
    FARES_SQL,
    NEW_FARES_SQL,
    QUOTE_ORDER,
    QUOTES_SQL,
    comparable,
    fares,
    new_fares,
    quotes,
    table,
)
from farewind.schemas import CHANGE_COLUMNS, FARE, FARE_KEYS, QUOTE_KEYS
from farewind.scratch import new_folder, passing_tables, stored

_NOW = "2001-08-02 00:00:00"
_THEN = "1998-01-01 00:00:00"
# The test quotes are dated by day over six years, so each look-back unit is a quarter year.
_HOURS = tuple(2190 * back for back in LOOK_BACK_HOURS)


def _fare_update(spark, sf_dir):
    """New prices for one airline's fares, and fares of a new airline."""
    known = fares(spark, sf_dir).filter(F.col("Airline") == "AIR_NO")
    repriced = known.groupBy(*FARE_KEYS).agg((F.min("Price") + 25).alias("Price"))
    return repriced.unionByName(new_fares(spark, sf_dir))


def merge_upsert(spark, sf_dir):
    target = fares(spark, sf_dir).select(*FARE.names)
    return changelog.merge_upsert(target, _fare_update(spark, sf_dir), FARE_KEYS)


def merge_changes(spark, sf_dir):
    target = fares(spark, sf_dir).select(*FARE.names)
    return changelog.merge_changes(target, _fare_update(spark, sf_dir), FARE_KEYS)


def _through_log(spark, target, source, keys):
    """An upsert kept in a change log by row, and the log's newest state."""
    path = new_folder(spark, "upsert-log")
    names = target.columns
    schema = T.StructType([*target.schema.fields, T.StructField(changelog.ROW_ID, T.StringType()), *CHANGE_COLUMNS.fields])
    changelog.append_commit(target, path, 0, "2024-01-01 00:00:00", op="I", row_ids=True)
    log = changelog.read_changes(spark, path, schema)
    with passing_tables():
        before = stored(changelog.as_of(log, [changelog.ROW_ID]), "before")
        changes = changelog.merge_changes(before, source, keys)
        changelog.append_commit(changes, path, 1, "2024-01-02 00:00:00")
    # a late retry of the first commit, in another order: it is finished, so nothing is written
    changelog.append_commit(target.hint("rebalance", *keys), path, 0, "2024-01-01 00:00:00", op="I", row_ids=True)
    log = changelog.read_changes(spark, path, schema)
    return changelog.as_of(log, [changelog.ROW_ID]).select(*names)


def upsert_through_log(spark, sf_dir):
    target = fares(spark, sf_dir).select(*FARE.names)
    return _through_log(spark, target, _fare_update(spark, sf_dir), FARE_KEYS)


_SEGMENT = "nullif(c_mktsegment, 'BUILDING') AS segment"


def _accounts(spark, sf_dir):
    """Customers with null keys among them, and an update of them with suppliers added."""
    customers = table(spark, sf_dir, "customer")
    target = customers.selectExpr("c_name AS name", _SEGMENT, "c_acctbal AS balance")
    source = customers.selectExpr("c_name AS name", _SEGMENT, "c_acctbal + 1 AS balance")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS name", "'SUPPLIER' AS segment", "s_acctbal AS balance"
    )
    return target, source.unionByName(suppliers), ["name", "segment"]


def merge_null_keys(spark, sf_dir):
    return changelog.merge_upsert(*_accounts(spark, sf_dir))


def upsert_null_keys_through_log(spark, sf_dir):
    return _through_log(spark, *_accounts(spark, sf_dir))


def as_of_compacted(spark, sf_dir):
    """A state read from a log whose older changes have been compacted."""
    short = changelog.compact(_log(spark, sf_dir), QUOTE_KEYS, "1997-01-01 00:00:00", QUOTE_ORDER)
    return _state(changelog.as_of(stored(short, "short-log"), QUOTE_KEYS, _THEN, QUOTE_ORDER))


def update_where(spark, sf_dir):
    rows = fares(spark, sf_dir).select(*FARE.names)
    return changelog.update_where(rows, "Airline = 'AIR_NO' AND Source = 'S1'", {"Price": "5000"})


def update_changes(spark, sf_dir):
    rows = fares(spark, sf_dir).select(*FARE.names)
    return changelog.update_changes(rows, "Airline = 'AIR_NO' AND Source = 'S1'", {"Price": "5000"})


def update_where_decimal(spark, sf_dir):
    rows = quotes(spark, sf_dir).select("flight_departure", "source", "destination", "price")
    updated = changelog.update_where(
        rows, "source = 'N1' AND destination = 'N2'", {"price": "'234'"}
    )
    return comparable(updated)


def _log(spark, sf_dir):
    return quotes(spark, sf_dir)


def _state(df):
    return comparable(df.drop("_seq"))


def quotes_as_of(spark, sf_dir):
    return _state(changelog.as_of(_log(spark, sf_dir), QUOTE_KEYS, _THEN, QUOTE_ORDER))


def quotes_current(spark, sf_dir):
    return _state(changelog.as_of(_log(spark, sf_dir), QUOTE_KEYS, order=QUOTE_ORDER))


def change_history(spark, sf_dir):
    return comparable(changelog.history(_log(spark, sf_dir)))


def history_version_zero(spark, sf_dir):
    return comparable(changelog.history(_log(spark, sf_dir)).where("version = 0"))


def _written_log(spark, sf_dir):
    path, log = new_folder(spark, "quote-log"), _log(spark, sf_dir)
    changelog.import_log(log, path)
    return path, log.schema


def quotes_as_of_by_notes(spark, sf_dir):
    """A past state of a written log, from the folders of the commits up to that time."""
    path, schema = _written_log(spark, sf_dir)
    return _state(changelog.read_state(spark, path, schema, QUOTE_KEYS, _THEN, QUOTE_ORDER))


def quotes_after_baseline(spark, sf_dir):
    """The newest state of a written log, read from its baseline only."""
    path, schema = _written_log(spark, sf_dir)
    number = changelog.commit_notes(spark, path).agg(F.max("version")).first()[0] + 1
    changelog.append_baseline(spark, path, schema, QUOTE_KEYS, number, _NOW, QUOTE_ORDER)
    return _state(changelog.read_state(spark, path, schema, QUOTE_KEYS, order=QUOTE_ORDER))


def history_from_notes(spark, sf_dir):
    """The history of a written log, without a look at its data."""
    path, _ = _written_log(spark, sf_dir)
    return comparable(changelog.log_history(spark, path))


def union_versions(spark, sf_dir):
    rows = changelog.union_versions(_log(spark, sf_dir), QUOTE_KEYS, [20, 40], QUOTE_ORDER)
    return _state(rows)


def union_tables(spark, sf_dir):
    rows = fares(spark, sf_dir).select(*FARE.names)
    return changelog.union_tables(rows, new_fares(spark, sf_dir))


def reprice(spark, sf_dir):
    rows = quotes(spark, sf_dir).select(
        "updatedTime", "flight_departure", "source", "destination", "price"
    )
    return comparable(changelog.reprice(rows, 10, at=_NOW))


def _frames(spark, sf_dir):
    log = _log(spark, sf_dir)
    return changelog.compare_time_frames(log, QUOTE_KEYS, _NOW, _HOURS, QUOTE_ORDER)


def compare_time_frames(spark, sf_dir):
    return _state(_frames(spark, sf_dir))


def compare_time_frames_connection(spark, sf_dir):
    log = _log(spark, sf_dir).filter("source = 'N1' AND destination = 'N2'")
    frames = changelog.compare_time_frames(log, QUOTE_KEYS, _NOW, _HOURS, QUOTE_ORDER)
    return _state(frames)


def price_trend_ols(spark, sf_dir):
    lines = trends.price_trend(_frames(spark, sf_dir))
    return lines.select(
        "time_frame",
        F.round("slope", 9).alias("slope"),
        F.round("intercept", 2).alias("intercept"),
        F.round("r2", 8).alias("r2"),
        "n",
    )


def price_bars(spark, sf_dir):
    return comparable(trends.price_bars(_frames(spark, sf_dir)))


_FARE_COLUMNS = ", ".join(FARE.names)
_FARE_KEY_LIST = ", ".join(FARE_KEYS)
_SAME_FARE = " AND ".join(f"t.{key} = s.{key}" for key in FARE_KEYS)
_FARE_MERGE = f"""
WITH {FARES_SQL}, {NEW_FARES_SQL}, t AS (SELECT {_FARE_COLUMNS} FROM fares),
s AS (
  SELECT {_FARE_KEY_LIST}, cast(min(Price) + 25 AS int) AS Price FROM fares
  WHERE Airline = 'AIR_NO' GROUP BY {_FARE_KEY_LIST}
  UNION ALL SELECT {_FARE_COLUMNS} FROM new_fares)"""

_QUOTE_COLUMNS = (
    "flight_departure, source, destination, cast(price AS double) AS price,"
    " cast(updatedTime AS varchar) AS updatedTime"
)


def _state_sql(where: str = "true", extra: str = "") -> str:
    return f"""
SELECT {_QUOTE_COLUMNS}{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY flight_departure, source, destination
    ORDER BY _commit_ts DESC, _seq DESC) AS rn FROM quotes WHERE {where}) ranked
WHERE rn = 1 AND _op <> 'D'"""


def _frames_sql(where: str = "true") -> str:
    parts = [_state_sql(where, ", 'Current' AS time_frame")]
    for back in _HOURS:
        cutoff = f"_commit_ts <= timestamp '{_NOW}' - interval {back} hours"
        parts.append(_state_sql(f"{where} AND {cutoff}", f", '{back}hrs Ago' AS time_frame"))
    return " UNION ALL ".join(parts)


_HISTORY_SQL = f"""
WITH {QUOTES_SQL}, commits AS (
  SELECT _version AS version, cast(max(_commit_ts) AS varchar) AS timestamp,
    cast(sum(CASE _op WHEN 'I' THEN 1 ELSE 0 END) AS bigint) AS rows_inserted,
    cast(sum(CASE _op WHEN 'U' THEN 1 ELSE 0 END) AS bigint) AS rows_updated,
    cast(sum(CASE _op WHEN 'D' THEN 1 ELSE 0 END) AS bigint) AS rows_deleted
  FROM quotes GROUP BY _version)
SELECT * FROM commits"""

_UPSERTED = f"""{_FARE_MERGE}
SELECT {", ".join(f"t.{key}" for key in FARE_KEYS)}, coalesce(s.Price, t.Price) AS Price
FROM t LEFT JOIN s ON {_SAME_FARE}
UNION ALL SELECT {_FARE_COLUMNS} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_SAME_FARE})"""

_NULL_KEYS = f"""
WITH t AS (SELECT c_name AS name, {_SEGMENT}, c_acctbal AS balance FROM customer),
s AS (SELECT c_name AS name, {_SEGMENT}, c_acctbal + 1 AS balance FROM customer
  UNION ALL SELECT s_name, 'SUPPLIER', s_acctbal FROM supplier)
SELECT t.name, t.segment, coalesce(s.balance, t.balance) AS balance
FROM t LEFT JOIN s ON t.name = s.name AND t.segment = s.segment
UNION ALL SELECT name, segment, balance FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.name = s.name AND t.segment = s.segment)"""

QUERIES = {
    "merge_upsert": (
        merge_upsert,
        f"""{_FARE_MERGE}
SELECT {", ".join(f"t.{key}" for key in FARE_KEYS)}, coalesce(s.Price, t.Price) AS Price
FROM t LEFT JOIN s ON {_SAME_FARE}
UNION ALL SELECT {_FARE_COLUMNS} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_SAME_FARE})""",
    ),
    "merge_changes": (
        merge_changes,
        f"""{_FARE_MERGE}
SELECT {_FARE_COLUMNS},
  CASE WHEN EXISTS (SELECT 1 FROM t WHERE {_SAME_FARE}) THEN 'U' ELSE 'I' END AS _op
FROM s""",
    ),
    "merge_null_keys": (
        merge_null_keys,
        _NULL_KEYS,
    ),
    "upsert_through_log": (upsert_through_log, _UPSERTED),
    "upsert_null_keys_through_log": (upsert_null_keys_through_log, _NULL_KEYS),
    "update_where": (
        update_where,
        f"""WITH {FARES_SQL} SELECT {_FARE_KEY_LIST},
  CASE WHEN Airline = 'AIR_NO' AND Source = 'S1' THEN 5000 ELSE Price END AS Price FROM fares""",
    ),
    "update_changes": (
        update_changes,
        f"""WITH {FARES_SQL} SELECT {_FARE_KEY_LIST}, 5000 AS Price, 'U' AS _op FROM fares
WHERE Airline = 'AIR_NO' AND Source = 'S1'""",
    ),
    "update_where_decimal": (
        update_where_decimal,
        f"""WITH {QUOTES_SQL} SELECT flight_departure, source, destination,
  cast(CASE WHEN source = 'N1' AND destination = 'N2' THEN cast('234' AS decimal(10,2))
    ELSE price END AS double) AS price FROM quotes""",
    ),
    "quotes_as_of": (
        quotes_as_of,
        f"WITH {QUOTES_SQL} {_state_sql(f'''_commit_ts <= timestamp '{_THEN}' ''')}",
    ),
    "as_of_compacted": (
        as_of_compacted,
        f"WITH {QUOTES_SQL} {_state_sql(f'''_commit_ts <= timestamp '{_THEN}' ''')}",
    ),
    "quotes_current": (quotes_current, f"WITH {QUOTES_SQL} {_state_sql()}"),
    "change_history": (change_history, _HISTORY_SQL),
    "history_version_zero": (history_version_zero, f"{_HISTORY_SQL} WHERE version = 0"),
    "quotes_as_of_by_notes": (
        quotes_as_of_by_notes,
        f"WITH {QUOTES_SQL} {_state_sql(f'''_commit_ts <= timestamp '{_THEN}' ''')}",
    ),
    "quotes_after_baseline": (quotes_after_baseline, f"WITH {QUOTES_SQL} {_state_sql()}"),
    "history_from_notes": (history_from_notes, _HISTORY_SQL),
    "union_versions": (
        union_versions,
        f"WITH {QUOTES_SQL} "
        + " UNION ALL ".join(
            _state_sql(f"_version <= {v}", f", cast({v} AS bigint) AS version") for v in (20, 40)
        ),
    ),
    "union_tables": (
        union_tables,
        f"WITH {FARES_SQL}, {NEW_FARES_SQL} SELECT {_FARE_COLUMNS} FROM fares"
        f" UNION ALL SELECT {_FARE_COLUMNS} FROM new_fares",
    ),
    "reprice": (
        reprice,
        f"""WITH {QUOTES_SQL} SELECT '{_NOW}' AS updatedTime, flight_departure, source, destination,
  cast(cast(price + 10 AS decimal(10,2)) AS double) AS price FROM quotes""",
    ),
    "compare_time_frames": (compare_time_frames, f"WITH {QUOTES_SQL} {_frames_sql()}"),
    "compare_time_frames_connection": (
        compare_time_frames_connection,
        f"WITH {QUOTES_SQL} {_frames_sql('''source = 'N1' AND destination = 'N2' ''')}",
    ),
    "price_trend_ols": (
        price_trend_ols,
        f"""
WITH {QUOTES_SQL}, frames AS ({_frames_sql()}), points AS (
  SELECT time_frame, price AS y, epoch(cast(updatedTime AS timestamp)) AS x FROM frames)
SELECT time_frame, round(regr_slope(y, x), 9) AS slope, round(regr_intercept(y, x), 2) AS intercept,
  round(regr_r2(y, x), 8) AS r2, cast(regr_count(y, x) AS bigint) AS n
FROM points GROUP BY time_frame""",
    ),
    "price_bars": (
        price_bars,
        f"""
WITH {QUOTES_SQL}, frames AS ({_frames_sql()})
SELECT time_frame, updatedTime, cast(sum(cast(price AS decimal(10,2))) AS double) AS price
FROM frames GROUP BY time_frame, updatedTime""",
    ),
}
