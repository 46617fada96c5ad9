"""Lookups against tables with one row per key.

The right side is broadcast if its size is within the session's
``spark.sql.autoBroadcastJoinThreshold``; the left side, which may grow through
explodes that size estimates ignore, never is.  A larger right side is joined by
sort-merge, and hot keys of the left side are salted: their rows spread over
several tasks, and the single matching right row is repeated once per salt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.operators.filters import require
from gildstar.operators.skew import (
    ROWS_PER_TASK,
    estimated_bytes,
    hot_key_frame,
    hot_keys,
    hot_pairs,
    piece_counts,
    same_keys,
)


def _broadcast_limit(df: DataFrame) -> int:
    jconf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(jconf.autoBroadcastJoinThreshold())


def _hashable(kind: T.DataType) -> bool:
    """Whether values of a type can be hashed: no VARIANT or MAP at any depth."""
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.VariantType, T.MapType))


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Equi-join to a table that has at most one row per key.

    ``broadcast_bytes`` is the right-hand size up to which hot keys need no
    salt, by default the session's broadcast threshold.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookup joins are left or inner")
    on = list(on)
    source = require(left, *on) if how == "inner" else left
    limit = _broadcast_limit(right) if broadcast_bytes is None else broadcast_bytes
    if estimated_bytes(right) <= limit:
        return source.join(F.broadcast(right), on, how)
    hot = hot_keys(source, on, rows_per_task)
    if not hot:
        return source.join(right.hint("merge"), on, how)

    counts = piece_counts(source, hot, rows_per_task)
    salts = [(*[r[k] for k in on], n) for r, n in zip(hot, counts)]
    spread = hot_key_frame(source, on, salts, [T.StructField("_salts", T.IntegerType())])
    hashable = [f.name for f in source.schema.fields if _hashable(f.dataType)]
    marked = source.join(F.broadcast(spread), same_keys(source, spread, hot_pairs(on)), "left").select(
        *[source[c] for c in source.columns],
        F.coalesce(F.pmod(F.xxhash64(*[source[c] for c in hashable]), F.col("_salts")), F.lit(0)).alias("_salt"),
    )
    repeated = right.join(F.broadcast(spread), same_keys(right, spread, hot_pairs(on)), "left").select(
        *[right[c] for c in right.columns],
        F.explode(F.expr("sequence(0L, coalesce(_salts, 1) - 1L)")).alias("_salt"),
    )
    return marked.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")


@dataclass(frozen=True)
class Dim:
    """One dimension of a star: which key to bring in, and how to find it.

    ``match`` is the expression over the fact that equals ``business_key``;
    ``default`` fills the key of facts without a match; ``where`` restricts the
    dimension (N5) before the join.
    """

    table: DataFrame
    business_key: str
    key: str
    match: Column
    default: Column | None = None
    where: Column | None = None
    carry: Mapping[str, str] = field(default_factory=dict)


def star_join(fact: DataFrame, dims: Sequence[Dim], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Chain of left lookups (N4-N8), each adding the dimension's key."""
    out = fact
    for dim in dims:
        table = dim.table if dim.where is None else dim.table.filter(dim.where)
        slim = table.select(
            F.col(dim.business_key).alias("_match"),
            F.col(dim.key).alias("_key"),
            *[F.col(c).alias(name) for name, c in dim.carry.items()],
        )
        out = lookup(out.withColumn("_match", dim.match), slim, ["_match"], "left", rows_per_task)
        found = F.col("_key") if dim.default is None else F.coalesce(F.col("_key"), dim.default)
        out = out.withColumn(dim.key, found).drop("_match", "_key")
    return out


def enrich(
    spine: DataFrame, others: Sequence[DataFrame], on: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Left lookups that keep every spine row."""
    out = spine
    for other in others:
        out = lookup(out, other, on, "left", rows_per_task)
    return out
