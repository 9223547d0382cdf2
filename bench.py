"""Times registered queries; prints one JSON line.

Each query is built and run to the end (rows go to a sink that drops them): once to warm up,
then BENCH_RUNS times, of which the median counts. Names on the command line replace the
headline list; ``all`` stands for every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from farewind.plans.catalog import QUERIES
from farewind.scratch import release
from farewind.session import build_session

HEADLINE = [
    "top_callsigns", "positions_last_contact", "latest_positions", "path_segments",
    "path_segments_sliced", "contact_time_text", "run_sql_named", "cheapest_fares_top20",
    "fare_duration_minutes", "fare_price_bands", "fare_ratings_delay",
    "fare_ratings_preference", "label_index", "merge_upsert", "merge_changes", "update_where",
    "quotes_as_of", "change_history", "union_versions", "reprice", "compare_time_frames",
    "price_trend_ols", "csv_roundtrip", "state_documents", "append_table",
    "decode_events_batch", "decode_events_stream", "stream_append_parquet",
    "stream_foreach_batch", "stream_delay_summary", "upsert_through_log", "attach_fares",
    "recommend_routes",
    "recommend_with_prices",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    spark = build_session(
        "farewind-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        query = QUERIES[name][0]
        run(query, spark, sf_dir)
        seconds[name] = round(statistics.median(run(query, spark, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    release(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
