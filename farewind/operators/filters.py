"""Equality filters, facets and named-parameter SQL."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _All:
    def __repr__(self) -> str:
        return "ALL"


# Filter value that keeps every row; None instead keeps the rows where the column is null.
ALL = _All()


def where_equal(df: DataFrame, **values: Any) -> DataFrame:
    """Rows whose columns equal all the given values."""
    for name, value in values.items():
        if value is None:
            df = df.filter(F.col(name).isNull())
        elif value is not ALL:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, each once."""
    return df.select(column).distinct()


def facet_values(df: DataFrame, column: str, **values: Any) -> DataFrame:
    """The values of a column that remain once other columns are fixed."""
    return distinct_values(where_equal(df, **values), column)


def run_sql(
    spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **params: Any
) -> DataFrame:
    """SQL with ``:name`` markers bound as values and ``{name}`` markers bound as tables."""
    return spark.sql(text, args=params, **(tables or {}))
