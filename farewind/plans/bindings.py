"""The test tables seen as flight tables.

Every binding is a list of column expressions that mean the same in Spark and in DuckDB, so
the Spark queries and the SQL they are checked against start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATES = [
    "event_id",
    "cast(user_id as string) as icao24",
    "case when user_id % 31 = 0 then null else concat('C', cast(user_id % 97 as string)) end"
    " as callsign",
    "event_type as origin_country",
    "case when event_id % 17 = 0 then null else cast(event_id * 60 as bigint) end"
    " as time_position",
    "cast(event_id * 60 + user_id % 7 as bigint) as last_contact",
    "case when event_id % 13 = 0 then null else cast(event_id % 360 - 180 as double) end"
    " as longitude",
    "cast(event_id % 180 - 90 as double) as latitude",
    "value * 100 as baro_altitude",
    "value as velocity",
]

_SOURCE = "concat('S', cast(l_suppkey % 10 as string))"
_DESTINATION = "concat('D', cast(l_partkey % 10 as string))"
_QUANTITY = "cast(cast(l_quantity as int) as string)"

FARES = [
    "l_orderkey",
    "l_linenumber",
    "concat('AIR_', l_returnflag, l_linestatus) as Airline",
    "substr(cast(l_shipdate as string), 1, 10) as Date_Of_Journey",
    f"{_SOURCE} as Source",
    f"{_DESTINATION} as Destination",
    f"concat({_SOURCE}, ' -> ', {_DESTINATION}) as Route",
    "concat(lpad(cast(l_linenumber + 5 as string), 2, '0'), ':00') as Dep_Time",
    "concat(lpad(cast(cast(l_quantity as int) % 24 as string), 2, '0'), ':30') as Arrival_Time",
    f"case l_linenumber % 3 when 0 then concat({_QUANTITY}, 'h')"
    f" when 1 then concat({_QUANTITY}, 'm')"
    f" else concat({_QUANTITY}, 'h ', cast(l_linenumber * 5 as string), 'm') end as Duration",
    "case l_linenumber % 3 when 0 then 'non-stop' when 1 then '1 stop' else '2 stops' end"
    " as Total_Stops",
    "case when l_tax > 0.04 then 'No info' else 'In-flight meal not included' end"
    " as Additional_Info",
    "cast(floor(l_extendedprice / 10) as int) as Price",
]

# The log of price quotes: one commit per month, ties within it settled by the order number.
QUOTES = [
    "concat('F', cast(o_orderkey % 3 as string)) as flight_departure",
    "concat('N', cast(o_custkey % 10 as string)) as source",
    "concat('N', cast(o_custkey % 7 as string)) as destination",
    "cast(o_totalprice as decimal(10,2)) as price",
    "o_orderdate as updatedTime",
    "o_orderdate as _commit_ts",
    "o_orderkey as _seq",
    "cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 as bigint) as _version",
    "case when o_orderkey % 29 = 0 then 'D' else 'U' end as _op",
]

# Fares from orders, offered by an airline that no line item has.
NEW_FARES = [
    "'NEW' as Airline",
    "substr(cast(o_orderdate as string), 1, 10) as Date_Of_Journey",
    "o_orderpriority as Source",
    "o_orderstatus as Destination",
    "concat(o_orderpriority, ' -> ', o_orderstatus) as Route",
    "'10:00' as Dep_Time",
    "'12:00' as Arrival_Time",
    "'2h' as Duration",
    "'non-stop' as Total_Stops",
    "'No info' as Additional_Info",
    "cast(floor(o_totalprice / 10) as int) as Price",
]

QUOTE_ORDER = ("_commit_ts", "_seq")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*STATES)


def fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*FARES)


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quote log; ``_seq`` is a log column for ``QUOTE_ORDER`` only."""
    return table(spark, sf_dir, "orders").selectExpr(*QUOTES)


def new_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*NEW_FARES)


# The same tables for SQL text: ``WITH`` + these.
STATES_SQL = f"states AS (SELECT {', '.join(STATES)} FROM events)"
FARES_SQL = f"fares AS (SELECT {', '.join(FARES)} FROM lineitem)"
QUOTES_SQL = f"quotes AS (SELECT {', '.join(QUOTES)} FROM orders)"
NEW_FARES_SQL = f"new_fares AS (SELECT {', '.join(NEW_FARES)} FROM orders)"


def comparable(df: DataFrame) -> DataFrame:
    """Types that compare alike in both engines: doubles for decimals and floats, text for
    dates and times."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)
