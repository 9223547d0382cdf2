"""Stable pseudo-random assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farewind.functions._columns import as_column


def hash_bucket(key: Column | str, buckets: int) -> Column:
    """A bucket in ``[0, buckets)`` that depends on the key's text only.

    Unlike ``rand()`` it gives the same row the same bucket on every run and every retry.
    """
    prefix = F.substring(F.md5(as_column(key).cast("string")), 1, 8)
    return (F.conv(prefix, 16, 10).cast("bigint") % buckets).cast("int")
