"""Stream writers.

Every writer takes a checkpoint folder, which belongs to one output. With ``available_now``
(the default) a query stops once it has read what was there at its start; otherwise it runs
until it is stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Names of the folders of a batch: the query that its checkpoint belongs to, and its number.
_QUERY, _BATCH = "_farewind_query", "_farewind_batch"


def stream_to_table(
    sdf: DataFrame, name: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Append to a table, by path (anything with a ``/``) or by catalog name.

    The sink's own log makes each row appear exactly once.
    """
    writer = sdf.writeStream.format(fmt).outputMode("append")
    if "/" in name:
        return _prepared(writer.option("path", name), checkpoint, available_now).start()
    return _prepared(writer, checkpoint, available_now).toTable(name)


def stream_batches_to_table(
    sdf: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append batch by batch, each to its own folder.

    A batch that is run again after a failure replaces its folder, so nothing is doubled. The
    folder carries the identity of the query, which lives in its checkpoint: a stream with
    another checkpoint appends to what is there.
    """
    return _each_batch(sdf, path, checkpoint, lambda batch: batch, available_now)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table written by ``stream_batches_to_table``; without ``schema`` it is taken from a file."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop(_QUERY, _BATCH)


def stream_delay_summary(
    sdf: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Per batch and airline: number, sum and maximum of the delays."""

    def summary(batch: DataFrame) -> DataFrame:
        delay = F.col("DelayTime").try_cast("double")
        return batch.groupBy("Airline").agg(
            F.count(delay).alias("n"), F.sum(delay).alias("total"), F.max(delay).alias("longest")
        )

    return _each_batch(sdf, path, checkpoint, summary, available_now)


def read_delay_summary(spark: SparkSession, path: str) -> DataFrame:
    """Delays by airline over all batches so far."""
    return (
        read_batches(spark, path)
        .groupBy("Airline")
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total_delay"),
            F.max("longest").alias("max_delay"),
        )
        .withColumn("mean_delay", F.try_divide("total_delay", "n"))
    )


def stream_preview(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[Column],
    rows: int = 20,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the first ``rows`` rows of each batch for a live view (see ``read_preview``)."""

    def head(batch: DataFrame) -> DataFrame:
        return batch.orderBy(*order).limit(rows)

    return _each_batch(sdf, path, checkpoint, head, available_now)


def read_preview(spark: SparkSession, path: str, order: Sequence[Column], rows: int = 20) -> DataFrame:
    """The first ``rows`` rows of all batches so far, out of the heads that each has kept."""
    return read_batches(spark, path).orderBy(*order).limit(rows)


def stream_to_console(
    sdf: DataFrame, checkpoint: str, rows: int = 20, available_now: bool = True
) -> StreamingQuery:
    """Print some rows of each batch."""
    writer = sdf.writeStream.format("console").outputMode("append").option("numRows", rows)
    return _prepared(writer, checkpoint, available_now).start()


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Wait for a query, but no longer than ``timeout_s`` (None: to its end); then stop it.

    True if it had finished by itself. An error in the query is raised here.
    """
    try:
        if timeout_s is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout_s))
    finally:
        query.stop()


def _each_batch(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame],
    available_now: bool,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{path}/{_QUERY}={query}/{_BATCH}={batch_id}"
        shape(batch).write.mode("overwrite").parquet(folder)

    return _prepared(sdf.writeStream.foreachBatch(write), checkpoint, available_now).start()


def _prepared(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer
