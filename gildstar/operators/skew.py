"""Finding hot keys and cutting their rows into ordered slices.

A window or join that hashes on a key sends all rows of that key to one task.
Where a key may own a large share of the input, the operators here look first,
and change the plan for hot keys only: windows from one small sample, lookups
from one narrow, partially aggregated count per key.

What travels to the driver is bounded by the number of shuffle partitions P,
not by the data: windows take fewer than P hot keys and at most about
``2 * SLICES_PER_PARTITION * P`` slice bounds, as slices are no smaller than that
part of an average partition; lookups take the P largest keys (a key below the P-th largest
holds at most one average partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.functions.ordering import Order, sort_columns, sorts_before

ROWS_PER_TASK = 2_000_000
SMALL_INPUT_BYTES = 128 * 1024 * 1024
SLICES_PER_PARTITION = 4
MAX_SLICES_PER_KEY = 1024
SAMPLES_PER_SLICE = 32
PIECES_PER_TASK = 4


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """NULL-safe equality over (left column, right column) pairs."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> list[T.Row]:
    """Keys with more than ``rows_per_task`` rows, as (key..., _n), largest first.

    Inputs whose estimated size is small are not scanned: all of them together
    are one task's work.
    """
    if rows_per_task >= ROWS_PER_TASK and estimated_bytes(df) <= SMALL_INPUT_BYTES:
        return []
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .orderBy(F.col("_n").desc())
        .limit(shuffle_partitions(df))
        .collect()
    )


def piece_counts(df: DataFrame, hot: list[T.Row], rows_per_task: int) -> list[int]:
    """Into how many pieces to cut each hot key.

    Pieces are a fraction of a task's rows, so that several of them landing in
    one task by hash still make a normal task.
    """
    n_hot = sum(r["_n"] for r in hot)
    most = SLICES_PER_PARTITION * shuffle_partitions(df)
    piece = max(1, rows_per_task // PIECES_PER_TASK, -(-n_hot // most))
    return [min(MAX_SLICES_PER_KEY, -(-r["_n"] // piece)) for r in hot]


def hot_key_frame(
    df: DataFrame, keys: Sequence[str], rows: list[tuple], extra: list[T.StructField]
) -> DataFrame:
    """A local DataFrame (h0.., extra..) of hot keys, safe to broadcast: <= P rows."""
    fields = [T.StructField(f"_h{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields + extra))


def hot_pairs(keys: Sequence[str]) -> list[tuple[str, str]]:
    return [(k, f"_h{i}") for i, k in enumerate(keys)]


def slice_hot_keys(
    df: DataFrame, keys: Sequence[str], order: Order, rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame] | None:
    """Add ``_slice``, an int that never falls along ``order`` within a key.

    A key is hot if it holds more rows than ``rows_per_task`` and than an average
    partition, so fewer keys than partitions can be.  Hot keys are cut at values
    of the sort columns taken from one sample of keys and sort columns, at about
    equal distances, every other key gets slice 0 only.  Rows that tie on the
    whole order share a slice.  Returns (sliced input, sliced rows of hot keys
    only), or None when no key is hot.
    """
    total = df.count()
    if total <= rows_per_task:
        return None
    fair = max(rows_per_task, total // shuffle_partitions(df))
    piece = max(1, rows_per_task // PIECES_PER_TASK, total // (2 * SLICES_PER_PARTITION * shuffle_partitions(df)))
    fraction = min(1.0, SAMPLES_PER_SLICE / piece)
    step = max(1, round(piece * fraction))

    names = [name for name, _ in order]
    narrow = df.select(
        *[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], *[F.col(n).alias(f"_o{j}") for j, n in enumerate(names)]
    )
    sample = narrow.sample(fraction=fraction, seed=17) if fraction < 1.0 else narrow
    hot_names = [f"_h{i}" for i in range(len(keys))]
    positions = [(f"_o{j}", direction) for j, (_, direction) in enumerate(order)]
    by_key = Window.partitionBy(*hot_names)
    cuts = (
        sample.withColumn("_n", F.count(F.lit(1)).over(by_key))
        .filter(F.col("_n") > fair * fraction)
        .withColumn("_r", F.row_number().over(by_key.orderBy(*sort_columns(positions))))
        .filter((F.col("_r") % step == 0) & (F.col("_r") < F.col("_n")))
        .groupBy(*hot_names)
        .agg(F.array_sort(F.collect_list(F.struct("_r", F.struct(*[c for c, _ in positions]).alias("at")))).alias("_cuts"))
        .select(*hot_names, F.transform("_cuts", lambda c: c["at"]).alias("_bounds"))
    )
    # Collected, so that a recomputed task sees the same slices.
    found = cuts.collect()
    if not found:
        return None
    bounds = hot_key_frame(df, keys, [tuple(r) for r in found], [cuts.schema["_bounds"]])
    marked = df.join(F.broadcast(bounds), same_keys(df, bounds, hot_pairs(keys)), "left")
    slice_number = _count_before(order, F.col("_bounds"), max(len(r["_bounds"]) for r in found))
    sliced = marked.select(
        *[df[c] for c in df.columns],
        F.when(F.col("_bounds").isNull(), 0).otherwise(slice_number).alias("_slice"),
        F.col("_bounds").isNotNull().alias("_hot"),
    )
    return sliced.drop("_hot"), sliced.filter("_hot").drop("_hot")


def _count_before(order: Order, bounds: Column, n_bounds: int) -> Column:
    """Binary search: how many of the at most ``n_bounds`` sorted bounds come before the row."""
    steps = F.array(*[F.lit(1 << b) for b in range(n_bounds.bit_length() - 1, -1, -1)])
    row = [F.col(name) for name, _ in order]

    def narrowed(i: Column, step: Column) -> Column:
        at = F.get(bounds, i + step - 1)
        earlier = sorts_before([at[f"_o{j}"] for j in range(len(order))], row, order)
        return F.when((i + step <= F.size(bounds)) & earlier, i + step).otherwise(i)

    return F.aggregate(steps, F.lit(0), narrowed)
