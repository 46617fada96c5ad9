"""Roll-ups, ordered text aggregation, distinct members, global scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildstar.functions.ordering import Order


def any_true(condition: Column) -> Column:
    """True if the condition held in some row; NULL counts as false."""
    return F.bool_or(F.coalesce(condition, F.lit(False)))


def rounded_avg(value: Column | str, digits: int) -> Column:
    """Average rounded half up."""
    return F.round(F.avg(value), digits)


def concat_ordered(text: str, order: Order, separator: str = ", ") -> Column:
    """Text of a group joined in the given order.

    The result is one value per group, so use it on groups that are small by
    construction, such as the output of ``top_k_per_group``.
    """
    nulls = {"asc": "ASC NULLS LAST", "desc": "DESC NULLS FIRST"}
    by = ", ".join(f"`{name}` {nulls[direction]}" for name, direction in order)
    return F.expr(f"listagg(`{text}`, '{separator}') WITHIN GROUP (ORDER BY {by})")


def distinct_members(df: DataFrame, column: str, name: str, separator: str = ",") -> DataFrame:
    """S1+S3+P6+G6: distinct trimmed, non-blank members of delimited text."""
    pieces = F.split(F.col(column), f"\\Q{separator}\\E", -1)
    return (
        df.select(F.explode(pieces).alias("_piece"))
        .select(F.trim("_piece").alias(name))
        .filter(F.col(name) != "")
        .distinct()
    )


def overall_max(df: DataFrame, column: str) -> Column:
    """MAX over the whole table as a scalar subquery, evaluated once."""
    return df.agg(F.max(column)).scalar()


def rollup_by(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """G1: grouped aggregates, partially aggregated before the shuffle."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggregates.items()])
