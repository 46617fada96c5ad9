"""Generated and versioned dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.operators.filters import null_of


def static_dim(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A3: inline constant table."""
    return spark.createDataFrame(list(rows), schema)


def _day(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def date_spine(
    spark: SparkSession,
    start: date | str | Column,
    end: date | str | Column,
    name: str = "date_day",
    include_end: bool = True,
) -> DataFrame:
    """A4: one row per day from start to end; bounds may be scalar subqueries."""
    days = F.explode(F.sequence(_day(start), _day(end), F.expr("interval 1 day")))
    spine = spark.range(1).select(days.alias(name))
    return spine if include_end else spine.filter(F.col(name) < _day(end))


def current_dim(df: DataFrame, valid_from: str) -> DataFrame:
    """Validity columns of a dimension that holds current rows only."""
    return df.withColumnRenamed(valid_from, "valid_from").withColumns(
        {"valid_to": null_of("timestamp_ntz"), "is_current": F.lit(True)}
    )
