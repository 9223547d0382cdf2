"""Properties of the plans themselves."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import SMOKE_DIR, queries

# Streams and file round trips run at build time; their result is a plain scan.
PURE = [
    "top_callsigns", "positions_last_contact", "latest_positions", "flight_track",
    "path_segments", "path_segments_sliced", "contact_time_text", "fare_duration_minutes",
    "fare_price_bands", "fare_ratings_delay", "fare_ratings_preference", "label_index",
    "merge_upsert", "merge_changes", "update_where", "quotes_as_of", "compare_time_frames",
    "price_trend_ols", "decode_events_batch", "attach_fares",
]


def plan(spark, name):
    """The plan as it is before execution (AQE repeats operators afterwards)."""
    df = queries()[name](spark, SMOKE_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_rows_stay_in_the_jvm(spark, name):
    text = plan(spark, name)
    assert not re.search("Python|Pandas|Arrow", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_time_frames_read_the_log_once(spark):
    text = plan(spark, "compare_time_frames")
    assert text.count("FileScan") == 1
    # Log rows are reduced before the first exchange; the second moves the reduced rows.
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_max_by" in text


def test_as_of_is_one_exchange_after_a_pushed_filter(spark):
    text = plan(spark, "quotes_as_of")
    assert text.count("Exchange ") == 1 and "partial_max_by" in text
    assert "LessThanOrEqual(o_orderdate,1998-01-01T00:00)" in text


def test_top_k_does_not_sort_everything(spark):
    for name in ("top_callsigns", "cheapest_fares_top20"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "distinct_destinations")
    assert "ReadSchema: struct<l_partkey:bigint>" in text
    text = plan(spark, "positions_last_contact_country")
    assert "EqualTo(event_type,view)" in text and "props" not in text


def test_partition_folders_are_pruned(spark):
    text = plan(spark, "overwrite_partitioned")
    assert re.search(r"PartitionFilters: \[isnotnull\(origin_country#\d+\), \(origin_country", text)


def test_labels_are_counted_in_one_scan(spark):
    text = plan(spark, "label_index")
    assert text.count("label-counts") and "lineitem" not in text
    for name in ("fare_ratings_delay", "fare_ratings_preference", "attach_fares"):
        assert plan(spark, name).count("lineitem.parquet") <= 2
