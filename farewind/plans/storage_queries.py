"""Files, catalog tables and literal-free round trips through them.

Each query writes a given table to a new folder of the shared scratch space and reads it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from farewind import sinks, sources
from farewind.operators import changelog
from farewind.operators.filters import run_sql
from farewind.plans.bindings import FARES_SQL, QUOTES_SQL, STATES_SQL, comparable, fares, quotes, states, table
from farewind.schemas import FARE, QUOTE
from farewind.scratch import new_folder

_FARE_COLUMNS = ", ".join(FARE.names)
_REPRICED = "2001-08-02 00:00:00"
_INFERRED = ("Airline", "Source", "Destination", "Route", "Duration", "Price")


def csv_roundtrip(spark, sf_dir):
    path = new_folder(spark, "fares-csv")
    rows = fares(spark, sf_dir).select(*FARE.names)
    sinks.write_table(rows, path, fmt="csv", header=True)
    return sources.read_fares_csv(spark, path)


def csv_inferred(spark, sf_dir):
    path = new_folder(spark, "fares-csv")
    rows = fares(spark, sf_dir).select(*_INFERRED)
    sinks.write_table(rows, path, fmt="csv", header=True)
    return sources.read_csv_inferred(spark, path)


def _state_text(tail: str) -> str:
    """SQL for one state array as JSON text; ``tail`` is its last eight values."""
    number = "coalesce(cast({} AS string), 'null')"
    parts = [
        "concat('\"', icao24, '\"')",
        "coalesce(concat('\"', callsign, '\"'), 'null')",
        "concat('\"', origin_country, '\"')",
        number.format("time_position"),
        number.format("last_contact"),
        number.format("longitude"),
        number.format("latitude"),
        number.format("baro_altitude"),
    ]
    return f"concat('[', concat_ws(',', {', '.join(parts)}), ',{tail}]')"


# Fixed parts of the two states in each document: on_ground, velocity, true_track,
# vertical_rate, sensors, geo_altitude, squawk, spi, position_source.
_GROUNDED = 'true,0.5,90.25,null,null,10.5,"1000",true,0'
_FLYING = 'false,230.5,181.0,-1.5,[3,14],9000.0,null,false,"x"'


_BROKEN = "concat('{\"time\":', cast(last_contact AS string), ',\"states\":[[')"


def state_documents(spark, sf_dir):
    path = new_folder(spark, "state-documents")
    text = (
        "concat('{\"time\":', cast(last_contact AS string), ',\"states\":[', "
        f"{_state_text(_GROUNDED)}, ',', {_state_text(_FLYING)}, ']}}') AS value"
    )
    rows = states(spark, sf_dir)
    sinks.write_table(rows.selectExpr(text), path, fmt="text")
    # every so often a transfer broke off
    broken = rows.filter("event_id % 50 = 0").selectExpr(f"{_BROKEN} AS value")
    sinks.write_table(broken, path, mode="append", fmt="text")
    read = sources.read_state_documents(spark, path, on_malformed="keep")
    return read.withColumn("sensors", F.array_join(F.col("sensors").cast("array<string>"), " "))


def append_table(spark, sf_dir):
    path = new_folder(spark, "accounts")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS name", "s_nationkey AS nation", "s_acctbal AS balance"
    )
    sinks.write_table(customers, path)
    sinks.write_table(suppliers, path, mode="append")
    return sources.read_table(spark, path)


def overwrite_partitioned(spark, sf_dir):
    """A table laid out by country; the filter on it only reads that country's folder."""
    path = new_folder(spark, "states")
    rows = states(spark, sf_dir).drop("event_id")
    sinks.write_table(rows, path, partition_by=["origin_country"])
    return sources.read_table(spark, path).filter("origin_country = 'view'")


def table_lifecycle(spark, sf_dir):
    """Create, insert, copy with overwrite, read by name and through a view, drop."""
    run = uuid.uuid4().hex
    first, copy, view = f"quotes_{run}", f"quotes_copy_{run}", f"quotes_view_{run}"
    rows = quotes(spark, sf_dir).select(
        F.col("updatedTime").cast("timestamp").alias("updatedTime"),
        "flight_departure", "source", "destination", "price",
    )
    sinks.ensure_table(spark, first, QUOTE, path=new_folder(spark, first))
    sinks.ensure_table(spark, first, QUOTE)
    sinks.append_rows(rows, first)
    sinks.save_as_table(
        sources.read_table(spark, first), copy, path=new_folder(spark, copy)
    )
    sources.register_view(sources.read_table(spark, copy), view)
    result = run_sql(
        spark, f"SELECT flight_departure, source, destination, price FROM {view}"
    )
    spark.catalog.dropTempView(view)
    sinks.drop_tables(spark, [first, copy])
    return comparable(result)


def reprice_in_place(spark, sf_dir):
    """A catalog table replaced by its own rows with other prices."""
    name = f"quotes_{uuid.uuid4().hex}"
    rows = quotes(spark, sf_dir).select("updatedTime", "flight_departure", "source", "destination", "price")
    sinks.replace_table(rows, name, path=f"{new_folder(spark, 'quotes')}/table")
    sinks.replace_table(changelog.reprice(sources.read_table(spark, name), 10, at=_REPRICED), name)
    sinks.drop_generations(spark, name)
    result = sources.read_table(spark, name)
    result.schema  # the plan holds the table's files from here on
    sinks.drop_tables(spark, [name])
    return comparable(result)


_STATE_COLUMNS = (
    "icao24, callsign, origin_country, time_position, last_contact, longitude, latitude,"
    " baro_altitude"
)

QUERIES = {
    "reprice_in_place": (
        reprice_in_place,
        f"""WITH {QUOTES_SQL} SELECT '{_REPRICED}' AS updatedTime, flight_departure, source, destination,
  cast(cast(price + 10 AS decimal(10,2)) AS double) AS price FROM quotes""",
    ),
    "csv_roundtrip": (csv_roundtrip, f"WITH {FARES_SQL} SELECT {_FARE_COLUMNS} FROM fares"),
    "csv_inferred": (
        csv_inferred,
        f"WITH {FARES_SQL} SELECT {', '.join(_INFERRED)} FROM fares",
    ),
    "state_documents": (
        state_documents,
        f"""WITH {STATES_SQL}
SELECT {_STATE_COLUMNS}, true AS on_ground, 0.5::double AS velocity, 90.25::double AS true_track,
  cast(NULL AS double) AS vertical_rate, cast(NULL AS varchar) AS sensors,
  10.5::double AS geo_altitude, '1000' AS squawk, true AS spi, 0 AS position_source,
  cast(NULL AS varchar) AS document FROM states
UNION ALL
SELECT {_STATE_COLUMNS}, false, 230.5::double, 181.0::double, -1.5::double, '3 14', 9000.0::double,
  cast(NULL AS varchar), false, cast(NULL AS int), NULL FROM states
UNION ALL
SELECT {", ".join(["NULL"] * 17)}, {_BROKEN} FROM states WHERE event_id % 50 = 0""",
    ),
    "append_table": (
        append_table,
        "SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer"
        " UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier",
    ),
    "overwrite_partitioned": (
        overwrite_partitioned,
        f"WITH {STATES_SQL} SELECT {_STATE_COLUMNS}, velocity FROM states"
        " WHERE origin_country = 'view'",
    ),
    "table_lifecycle": (
        table_lifecycle,
        "SELECT concat('F', cast(o_orderkey % 3 AS varchar)) AS flight_departure,"
        " concat('N', cast(o_custkey % 10 AS varchar)) AS source,"
        " concat('N', cast(o_custkey % 7 AS varchar)) AS destination,"
        " o_totalprice AS price FROM orders",
    ),
}
