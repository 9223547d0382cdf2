"""Times some operators next to the plainer way to write the same job.

The plainer forms are one scan per look-back time, and a full outer join for an upsert.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench import run
from farewind.operators import changelog
from farewind.plans import change_queries
from farewind.plans.bindings import QUOTE_ORDER, fares, quotes
from farewind.schemas import FARE, FARE_KEYS, QUOTE_KEYS
from farewind.scratch import release
from farewind.session import build_session


def frames_by_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = quotes(spark, sf_dir)
    now = F.lit(change_queries._NOW).cast("timestamp_ntz")
    parts = [
        changelog.as_of(log, QUOTE_KEYS, now - F.make_dt_interval(hours=F.lit(h)), QUOTE_ORDER)
        .withColumn("time_frame", F.lit(f"{h}hrs Ago"))
        for h in change_queries._HOURS
    ]
    current = changelog.as_of(log, QUOTE_KEYS, order=QUOTE_ORDER)
    return reduce(
        DataFrame.unionByName, parts, current.withColumn("time_frame", F.lit("Current"))
    )


def upsert_by_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outer_join(spark, sf_dir, change_queries._fare_update(spark, sf_dir))


def _outer_join(spark: SparkSession, sf_dir: str, source: DataFrame) -> DataFrame:
    target = fares(spark, sf_dir).select(*FARE.names)
    source = source.withColumnRenamed("Price", "new")
    joined = target.join(source, list(FARE_KEYS), "full")
    return joined.select(*FARE_KEYS, F.coalesce("new", "Price").alias("Price"))


def _day_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New prices for the fares of one day."""
    day = fares(spark, sf_dir).filter("Date_Of_Journey = '1998-01-01'")
    return day.groupBy(*FARE_KEYS).agg((F.min("Price") + 25).alias("Price"))


def small_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fares(spark, sf_dir).select(*FARE.names)
    return changelog.merge_upsert(target, _day_update(spark, sf_dir), FARE_KEYS)


def small_upsert_by_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outer_join(spark, sf_dir, _day_update(spark, sf_dir))


PAIRS = {
    "compare_time_frames": (change_queries.compare_time_frames, frames_by_union),
    "merge_upsert": (change_queries.merge_upsert, upsert_by_outer_join),
    "merge_upsert of one day": (small_upsert, small_upsert_by_outer_join),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "farewind-shapes",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    result = {}
    for name, queries in PAIRS.items():
        times = []
        for query in queries:
            run(query, spark, sf_dir)
            times.append(round(statistics.median(run(query, spark, sf_dir) for _ in range(3)), 2))
        result[name] = {"here": times[0], "plainer": times[1]}
    release(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
