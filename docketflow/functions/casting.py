"""Typing helpers that never raise under ANSI mode: a bad value becomes NULL.

The input type is inspected when the plan is built, so already-typed input
(e.g. a timestamp column from parquet) costs only a cast, and strings from
JSON landing files are parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_timestamp(df: DataFrame, name: str) -> Column:
    """ISO-8601 string (offset normalised to the session zone) or typed value -> TIMESTAMP."""
    dt = _dtype(df, name)
    if isinstance(dt, T.TimestampType):
        return F.col(name)
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return F.try_to_timestamp(F.col(name).cast("string"))


def as_date(df: DataFrame, name: str) -> Column:
    """`YYYY-MM-DD` string or typed value -> DATE."""
    dt = _dtype(df, name)
    if isinstance(dt, T.DateType):
        return F.col(name)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(name))
    return F.col(name).cast("string").try_cast("date")


def to_decimal(col: Column, decimal_type: str) -> Column:
    """HALF_UP rounding cast; overflow, NaN and infinity give NULL instead of an error."""
    return col.try_cast(decimal_type)
