"""Ordered windows over a key's whole history (W5, W6, M3, M10), and carrying values forward.

The window operators cut hot keys into ordered slices (see ``skew``), work
inside the slices, and carry the little that crosses a slice border (the last
value, the row count) through a broadcast table of at most a few rows per
slice.  Results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gildstar.functions.ordering import Order, reverse_columns, sort_columns
from gildstar.operators.skew import ROWS_PER_TASK, same_keys, slice_hot_keys


def lag_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    value: str,
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Previous ``value`` of the same key along ``order``."""
    cut = slice_hot_keys(df, keys, order, rows_per_task)
    if cut is None:
        window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        return df.withColumn(name, F.lag(value).over(window))
    sliced, hot = cut

    last = _last_per_slice(hot, keys, order, value)
    carried = _renamed(
        last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice"))),
        keys,
        "_carry",
    )
    window = Window.partitionBy(*keys, "_slice").orderBy(*sort_columns(order))
    inside = sliced.withColumn(name, F.lag(value).over(window)).withColumn(
        "_at_start", F.row_number().over(window) == 1
    )
    joined = inside.join(F.broadcast(carried), _on_slice(inside, carried, keys), "left")
    return joined.select(
        *df.columns, F.when(F.col("_at_start"), F.col("_carry")).otherwise(F.col(name)).alias(name)
    )


def rank_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """1-based position of the row within its key along ``order``."""
    cut = slice_hot_keys(df, keys, order, rows_per_task)
    if cut is None:
        window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        return df.withColumn(name, F.row_number().over(window))
    sliced, hot = cut

    counts = hot.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _renamed(counts.withColumn("_offset", F.sum("_n").over(before)), keys, "_offset")
    window = Window.partitionBy(*keys, "_slice").orderBy(*sort_columns(order))
    inside = sliced.withColumn(name, F.row_number().over(window))
    joined = inside.join(F.broadcast(offsets), _on_slice(inside, offsets, keys), "left")
    position = F.col(name) + F.coalesce(F.col("_offset"), F.lit(0))
    return joined.select(*df.columns, position.cast("int").alias(name))


def fill_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    value: str,
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The last ``value`` that is not NULL in the same key, up to and with the row itself along ``order``."""

    def filled(*by: str):
        up_to = Window.partitionBy(*by).orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
        return F.last(value, ignorenulls=True).over(up_to)

    cut = slice_hot_keys(df, keys, order, rows_per_task)
    if cut is None:
        return df.withColumn(name, filled(*keys))
    sliced, hot = cut

    last = _last_per_slice(hot.filter(F.col(value).isNotNull()), keys, order, value)
    every = hot.groupBy(*keys, "_slice").agg(F.first(F.lit(None).cast("int")).alias("_none"))
    told = _renamed(last, keys, "_last")
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = _renamed(
        every.join(told, _on_slice(every, told, keys), "left")
        .select(*[every[k] for k in keys], every["_slice"], "_last")
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier)),
        keys,
        "_carry",
    )
    inside = sliced.withColumn(name, filled(*keys, "_slice"))
    joined = inside.join(F.broadcast(carried), _on_slice(inside, carried, keys), "left")
    return joined.select(*df.columns, F.coalesce(F.col(name), F.col("_carry")).alias(name))


def _last_per_slice(hot: DataFrame, keys: Sequence[str], order: Order, value: str) -> DataFrame:
    """(keys, _slice, _last): the value of each slice's last row; one row per slice leaves a map task."""
    narrow = hot.select(*keys, "_slice", F.col(value).alias("_last"), *[F.col(n).alias(f"_s{j}") for j, (n, _) in enumerate(order)])
    backwards = Window.partitionBy(*keys, "_slice").orderBy(*reverse_columns([(f"_s{j}", d) for j, (_, d) in enumerate(order)]))
    return narrow.withColumn("_r", F.row_number().over(backwards)).filter("_r = 1").select(*keys, "_slice", "_last")


def _renamed(per_slice: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return per_slice.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_slice").alias("_k_slice"),
        value,
    )


def _on_slice(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    pairs = [(k, f"_k{i}") for i, k in enumerate(keys)] + [("_slice", "_k_slice")]
    return same_keys(left, right, pairs)
