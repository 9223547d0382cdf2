"""Where rows come from: files, tables, streams and literal rows."""

from farewind.sources.batch import (
    read_csv_inferred,
    read_fares_csv,
    read_state_documents,
    read_table,
    register_view,
    rows_to_df,
)
from farewind.sources.streams import stream_broker, stream_fares_csv, stream_table

__all__ = [
    "read_csv_inferred",
    "read_fares_csv",
    "read_state_documents",
    "read_table",
    "register_view",
    "rows_to_df",
    "stream_broker",
    "stream_fares_csv",
    "stream_table",
]
