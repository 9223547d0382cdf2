"""Batch sinks and table definitions."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farewind.scratch import delete_folder, folder_names

# What a replaced table's folders have between the table's own path and a number.
_GENERATION = "-generation-"


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    **options: object,
) -> None:
    """Write to a path; ``mode`` is ``overwrite`` or ``append``.

    With ``partition_by`` the rows of a folder are brought together first, so that it gets few
    files; a folder that many rows go to is written by several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_as_table(
    df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet", path: str | None = None
) -> None:
    """Write to a catalog table, creating it if needed; ``path`` keeps its files elsewhere.

    A parquet table cannot be overwritten from itself in this way: ``replace_table`` can.
    """
    writer = df.write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create a parquet table or replace its rows, also by rows computed from itself.

    The rows are written to a fresh folder beside the table's, then the catalog is pointed to
    it, in one step: readers see the old rows or the new ones. Old folders stay for readers that
    have opened them, until ``drop_generations``; what a run that died has written is one of them.
    ``path`` is where a new table goes. Columns and their types may not change.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        save_as_table(df, name, path=path and f"{path}{_GENERATION}{uuid.uuid4().hex}")
        return
    known = [(field.name, field.dataType) for field in spark.table(name).schema]
    if [(field.name, field.dataType) for field in df.schema] != known:
        raise ValueError(f"the columns differ from those of {name}")
    fresh = f"{_family(_location(spark, name))}{_GENERATION}{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(name)


def drop_generations(spark: SparkSession, name: str) -> int:
    """Delete the folders of a replaced table that it no longer uses; how many there were."""
    location = _location(spark, name)
    parent, _, base = _family(location).rpartition("/")
    stale = [
        entry for entry in folder_names(spark, parent)
        if entry != location.rpartition("/")[2] and (entry == base or entry.startswith(f"{base}{_GENERATION}"))
    ]
    for entry in stale:
        delete_folder(spark, f"{parent}/{entry}")
    return len(stale)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}").filter("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def _family(location: str) -> str:
    return location.rpartition(_GENERATION)[0] or location


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str = "parquet",
    path: str | None = None,
) -> None:
    """Create an empty table unless one of that name exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt, schema=schema)


def append_rows(df: DataFrame, name: str) -> None:
    """Insert rows into a catalog table, columns matched by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name)


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop the tables that exist."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
