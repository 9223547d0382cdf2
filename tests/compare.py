"""Row-for-row comparison of a Spark query with its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(row) -> tuple:
    return tuple(
        None if isinstance(value, float) and math.isnan(value) else value for value in row
    )


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, types, number of rows, or rows (first few)."""
    relation = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} and {sorted(relation.columns)}"]
    found = []
    spark_types = dict(df.dtypes)
    oracle_types = dict(zip(relation.columns, map(str, relation.types)))
    for name in names:
        if _KINDS.get(spark_types[name], spark_types[name]) != oracle_types[name]:
            found.append(f"type of {name}: {spark_types[name]} and {oracle_types[name]}")
    chosen = ", ".join(f'"{name}"' for name in names)
    theirs = sorted(map(_plain, relation.select(chosen).fetchall()), key=_key)
    ours = sorted(map(_plain, df.select(*[f"`{name}`" for name in names]).collect()), key=_key)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} and {len(theirs)} rows")
    found += [f"{a} and {b}" for a, b in zip(ours, theirs) if a != b][:3]
    return found
