"""All registered queries."""

from __future__ import annotations

from farewind.plans import (
    change_queries,
    fare_queries,
    position_queries,
    recommend_queries,
    storage_queries,
    stream_queries,
)

QUERIES = {
    **position_queries.QUERIES,
    **fare_queries.QUERIES,
    **change_queries.QUERIES,
    **storage_queries.QUERIES,
    **stream_queries.QUERIES,
    **recommend_queries.QUERIES,
}
