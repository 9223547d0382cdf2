"""Fares: browsing, durations, bands, ratings and label indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from farewind.functions import (
    duration_minutes,
    hash_bucket,
    price_band,
    rating_delay,
    rating_preference,
)
from farewind.operators import fares as browse
from farewind.operators import recommend
from farewind.operators.filters import distinct_values, facet_values
from farewind.plans.bindings import FARES_SQL, QUOTES_SQL, comparable, fares, quotes, table

_LINE_KEY_SQL = "concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar))"


def line_key():
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def bucket_sql(buckets: int, key: str = _LINE_KEY_SQL) -> str:
    return f"cast(cast(concat('0x', substr(md5({key}), 1, 8)) AS bigint) % {buckets} AS int)"


def _part_sql(mark: str) -> str:
    digits = f"regexp_extract(Duration, '([0-9]+){mark}', 1)"
    return f"(CASE WHEN {digits} = '' THEN 0 ELSE try_cast({digits} AS bigint) END)"


MINUTES_SQL = f"cast({_part_sql('h')} * 60 + {_part_sql('m')} AS int)"


def index_sql(column: str, name: str) -> str:
    """A table of (label, frequency, idx) in SQL."""
    return f"""{name} AS (
  SELECT {column} AS label, count(*) AS frequency,
    cast(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS double) AS idx
  FROM fares WHERE {column} IS NOT NULL GROUP BY {column})"""


def fares_by_destination(spark, sf_dir):
    return browse.fares_for(fares(spark, sf_dir), "D3").select("Airline", "Source", "Price")


def cheapest_fares_top20(spark, sf_dir):
    return browse.cheapest_fares(fares(spark, sf_dir), "D3")


def fare_duration_minutes(spark, sf_dir):
    return fares(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "Duration", duration_minutes("Duration").alias("minutes")
    )


def fare_price_bands(spark, sf_dir):
    return fares(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "Price", price_band("Price").alias("price_range")
    )


def rated_inputs(spark, sf_dir, *labels):
    """Fares with minutes, a delay, the customer who bought them, and indexes of ``labels``."""
    buyers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("int").alias("userId")
    )
    rows = fares(spark, sf_dir).withColumns(
        {
            "minutes": duration_minutes("Duration"),
            "DelayTime": hash_bucket(line_key(), 61).cast("string"),
        }
    )
    if not labels:
        return rows.join(buyers, "l_orderkey"), {}
    outputs = {name: f"{name.lower()}_index" for name in labels}
    indexed, tables = recommend.index_labels(
        rows, outputs, on_null={name: "skip" if name == "Route" else "keep" for name in labels}
    )
    return indexed.join(buyers, "l_orderkey"), tables


def _rated(spark, sf_dir):
    rows = fares(spark, sf_dir).withColumns(
        {"minutes": duration_minutes("Duration"), "DelayTime": hash_bucket(line_key(), 61).cast("string")}
    )
    return recommend.index_labels(rows, {"Airline": "airline_index"}, on_null={"Airline": "keep"})[0]


def fare_ratings_delay(spark, sf_dir):
    rating = rating_delay("Price", "minutes", "DelayTime", "airline_index")
    return comparable(_rated(spark, sf_dir).select("l_orderkey", "l_linenumber", rating.alias("rating")))


def fare_ratings_preference(spark, sf_dir):
    rating = rating_preference("Price", "minutes", "airline_index")
    return comparable(_rated(spark, sf_dir).select("l_orderkey", "l_linenumber", rating.alias("rating")))


def distinct_destinations(spark, sf_dir):
    return distinct_values(fares(spark, sf_dir), "Destination")


def facet_dates(spark, sf_dir):
    return facet_values(fares(spark, sf_dir), "Date_Of_Journey", Source="S1", Destination="D3")


def facet_departures(spark, sf_dir):
    rows = quotes(spark, sf_dir)
    return facet_values(rows, "flight_departure", source="N1", destination="N2")


def quotes_connection(spark, sf_dir):
    rows = browse.quotes_for(quotes(spark, sf_dir), "N1", "N2")
    return comparable(rows.select("flight_departure", "source", "destination", "price"))


def stable_user_bucket(spark, sf_dir):
    return fares(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", hash_bucket(line_key(), 100).alias("userId")
    )


def label_index(spark, sf_dir):
    tables = recommend.label_indexes(fares(spark, sf_dir), ["Airline", "Route", "Source"])
    return tables.withColumnRenamed("column", "kind")


def route_sources(spark, sf_dir):
    return recommend.route_sources(fares(spark, sf_dir))


_RATED_SQL = f"""WITH {FARES_SQL}, {index_sql("Airline", "airlines")}, rated AS (
  SELECT l_orderkey, l_linenumber, cast(Price AS double) AS price, idx AS airline,
    cast({MINUTES_SQL} AS double) AS minutes, cast({bucket_sql(61)} AS double) AS delay
  FROM fares JOIN airlines ON fares.Airline = airlines.label)"""

_BAND_SQL = "cast(floor(Price / 500) AS bigint) * 500"

PRICE_RANGE_SQL = (
    f"concat(cast({_BAND_SQL} AS varchar), '~', cast({_BAND_SQL} + 500 AS varchar))"
)

QUERIES = {
    "fares_by_destination": (
        fares_by_destination,
        f"WITH {FARES_SQL} SELECT Airline, Source, Price FROM fares WHERE Destination = 'D3'",
    ),
    "cheapest_fares_top20": (
        cheapest_fares_top20,
        f"WITH {FARES_SQL} SELECT Airline, Source, Price FROM fares WHERE Destination = 'D3'"
        " ORDER BY Price, Airline, Source LIMIT 20",
    ),
    "fare_duration_minutes": (
        fare_duration_minutes,
        f"WITH {FARES_SQL} SELECT l_orderkey, l_linenumber, Duration, {MINUTES_SQL} AS minutes"
        " FROM fares",
    ),
    "fare_price_bands": (
        fare_price_bands,
        f"WITH {FARES_SQL} SELECT l_orderkey, l_linenumber, Price,"
        f" {PRICE_RANGE_SQL} AS price_range FROM fares",
    ),
    "fare_ratings_delay": (
        fare_ratings_delay,
        f"""{_RATED_SQL}
SELECT l_orderkey, l_linenumber, cast(cast(
  0.3::double * delay + 0.5::double * (1.0::double / (price + 1.0::double))
  + 0.1::double * (1.0::double / (minutes + 1.0::double)) + 0.1::double * airline
  AS float) AS double) AS rating
FROM rated""",
    ),
    "fare_ratings_preference": (
        fare_ratings_preference,
        f"""{_RATED_SQL}
SELECT l_orderkey, l_linenumber, cast(cast(
  0.7::double * airline + 0.2::double * (1.0::double / (price + 1.0::double))
  + 0.1::double * (1.0::double / (minutes + 1.0::double))
  AS float) AS double) AS rating
FROM rated""",
    ),
    "distinct_destinations": (
        distinct_destinations,
        f"WITH {FARES_SQL} SELECT DISTINCT Destination FROM fares",
    ),
    "facet_dates": (
        facet_dates,
        f"WITH {FARES_SQL} SELECT DISTINCT Date_Of_Journey FROM fares"
        " WHERE Source = 'S1' AND Destination = 'D3'",
    ),
    "facet_departures": (
        facet_departures,
        f"WITH {QUOTES_SQL} SELECT DISTINCT flight_departure FROM quotes"
        " WHERE source = 'N1' AND destination = 'N2'",
    ),
    "quotes_connection": (
        quotes_connection,
        f"WITH {QUOTES_SQL} SELECT flight_departure, source, destination,"
        " cast(price AS double) AS price FROM quotes WHERE source = 'N1' AND destination = 'N2'",
    ),
    "stable_user_bucket": (
        stable_user_bucket,
        f"SELECT l_orderkey, l_linenumber, {bucket_sql(100)} AS userId FROM lineitem",
    ),
    "label_index": (
        label_index,
        f"""WITH {FARES_SQL}, {index_sql("Airline", "a")}, {index_sql("Route", "r")},
{index_sql("Source", "s")}
SELECT *, 'Airline' AS kind FROM a UNION ALL SELECT *, 'Route' FROM r
UNION ALL SELECT *, 'Source' FROM s""",
    ),
    "route_sources": (
        route_sources,
        f"""
WITH {FARES_SQL}, pairs AS (
  SELECT Route, Source, row_number() OVER (PARTITION BY Route ORDER BY count(*) DESC, Source) AS rn
  FROM fares GROUP BY Route, Source)
SELECT Route, Source FROM pairs WHERE rn = 1""",
    ),
}
