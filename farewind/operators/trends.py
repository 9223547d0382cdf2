"""Price movement between time frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def price_trend(
    df: DataFrame,
    by: Sequence[str] = ("time_frame",),
    price: str = "price",
    time: str = "updatedTime",
) -> DataFrame:
    """Least-squares line of price over time (epoch seconds) for each group."""
    y = F.col(price).cast("double")
    x = _epoch_micros(df, time) / F.lit(1e6)
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def _epoch_micros(df: DataFrame, time: str) -> Column:
    """Microseconds since 1970; a zone-less time counts as UTC whatever the session zone is."""
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        return F.expr(
            f"(`{time}` - timestamp_ntz'1970-01-01 00:00:00') div interval '0.000001' second"
        )
    return F.unix_micros(F.col(time).cast("timestamp"))


def price_bars(
    df: DataFrame,
    by: Sequence[str] = ("time_frame", "updatedTime"),
    price: str = "price",
) -> DataFrame:
    """Height of each bar: prices summed by group and time."""
    return df.groupBy(*by).agg(F.sum(price).alias(price))
