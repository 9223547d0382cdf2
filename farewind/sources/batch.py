"""Batch sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farewind.schemas import FARE, STATE


def read_fares_csv(spark: SparkSession, path: str, schema: T.StructType = FARE) -> DataFrame:
    """Fare files with a header row; a price that is not a number becomes null."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV files with types guessed from the data (an extra pass over the files).

    Without ``header`` the first row is data and columns are named ``_c0``, ``_c1``, ...
    """
    return spark.read.option("inferSchema", True).option("header", header).csv(path)


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A table by path (anything with a ``/``) or by catalog name."""
    if "/" in name:
        return spark.read.format(fmt).load(name)
    return spark.read.table(name)


def read_state_documents(
    spark: SparkSession, path: str, multi_line: bool = False, on_malformed: str = "skip"
) -> DataFrame:
    """Aircraft states from documents ``{"time": t, "states": [[...], ...]}``.

    Each state is an array whose positions have fixed meanings; values that do not fit their
    column become null. ``multi_line`` is for files that hold one indented document. What is
    no document at all is left out, is an error (``"fail"``, when rows are read), or is kept
    (``"keep"``) as a row without a state whose added column ``document`` has the text.
    """
    if on_malformed not in ("skip", "fail", "keep"):
        raise ValueError(f"unknown choice for malformed documents: {on_malformed}")
    documents = (
        spark.read.schema("time bigint, states array<array<string>>, document string")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", "document")
        .option("mode", "FAILFAST" if on_malformed == "fail" else "PERMISSIVE")
        .json(path)
    )
    if on_malformed == "keep":
        sound = F.when(F.col("document").isNull(), F.col("states"))
        states = documents.filter("states is not null or document is not null").select(
            F.explode_outer(sound).alias("state"), "document"
        ).filter("state is not null or document is not null")
    else:
        states = documents.filter("document is null").select(F.explode("states").alias("state"))
    columns = [_position(place, field).alias(field.name) for place, field in enumerate(STATE)]
    return states.select(*columns, *(["document"] if on_malformed == "keep" else []))


def _position(place: int, field: T.StructField) -> Column:
    value = F.get("state", F.lit(place))
    if isinstance(field.dataType, T.ArrayType):
        return F.from_json(value, field.dataType)
    return value.try_cast(field.dataType)


def rows_to_df(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few literal rows, for corrections and fixtures."""
    return spark.createDataFrame(list(rows), schema)


def register_view(df: DataFrame, name: str) -> None:
    """Make a DataFrame addressable in SQL for this session."""
    df.createOrReplaceTempView(name)
