"""Structured Streaming: decoding events, and writing streams to tables."""

from farewind.streaming.decode import decode_fare_events, flatten_struct
from farewind.streaming.writers import (
    read_batches,
    read_delay_summary,
    read_preview,
    run_available,
    stream_batches_to_table,
    stream_delay_summary,
    stream_preview,
    stream_to_console,
    stream_to_table,
)

__all__ = [
    "decode_fare_events",
    "flatten_struct",
    "read_batches",
    "read_delay_summary",
    "read_preview",
    "run_available",
    "stream_batches_to_table",
    "stream_delay_summary",
    "stream_preview",
    "stream_to_console",
    "stream_to_table",
]
