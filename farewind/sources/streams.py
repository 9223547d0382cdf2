"""Streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farewind.schemas import FARE


def stream_fares_csv(
    spark: SparkSession, folder: str, schema: T.StructType = FARE, max_files: int | None = None
) -> DataFrame:
    """Fare files as they arrive in a folder, at most ``max_files`` in one batch."""
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def stream_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Rows appended to a table, by path (needs ``schema``) or by catalog name."""
    reader = spark.readStream.format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if "/" not in name:
        return reader.table(name)
    return (reader.schema(schema) if schema is not None else reader).load(name)


def stream_broker(
    spark: SparkSession,
    options: Mapping[str, str],
    fmt: str = "kafka",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The raw envelopes of a message broker.

    Needs the broker's connector on the class path. ``options`` go to it unchanged, e.g.
    ``kafka.bootstrap.servers`` and ``subscribe``. Files of envelopes are read by naming their
    format and passing ``schema``, which a broker has of itself.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load()
