"""Latest row and top-k per key.

``row_number() <= k`` over a window is planned with a group limit before and
after the shuffle: each map task forwards at most k rows per key, so a key that
owns a third of the table reaches its reducer as k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gildstar.functions.ordering import Order, sort_columns
from gildstar.operators.filters import require


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Order, k: int, rank_name: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group; ``rank_name`` keeps the rank."""
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    rank = rank_name or "_rank"
    top = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
    return top if rank_name else top.drop(rank)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key by ``order``.

    Rows with a NULL key are dropped beforehand: no caller keeps them, and they
    would all meet in one task.
    """
    return top_k_per_group(require(df, *keys), keys, order, 1)
