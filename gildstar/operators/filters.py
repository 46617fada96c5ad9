"""Row filters and audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows in which any of the columns is NULL.

    Plain IS NOT NULL predicates, which (unlike ``dropna``) reach the scan.
    """
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def non_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose text is NULL or only spaces."""
    return df.filter(F.trim(F.col(column)) != "")


def load_stamp(load_ts: datetime | str) -> Column:
    """The run's load time as a zone-less timestamp literal."""
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def with_load_ts(df: DataFrame, load_ts: datetime | str, name: str = "_loaded_at") -> DataFrame:
    """Stamp every row with the run's load time (a parameter, not the clock)."""
    return df.withColumn(name, load_stamp(load_ts))


def null_of(dtype: str) -> Column:
    """Typed NULL literal."""
    return F.lit(None).cast(dtype)
