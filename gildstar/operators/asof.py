"""Joins to the version that was valid at a time (L6 with facts).

Facts and versions of a key are laid on one time line, and each fact takes the
last version that began before it, by one ordered window.  No pair of a fact and
a version is formed but the one that is wanted, so long histories cost nothing,
and a key with many facts or versions is cut by time (``series.fill_by``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.operators.series import fill_by
from gildstar.operators.skew import ROWS_PER_TASK


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every fact with ``columns`` of the version of its key that was valid at its time.

    A version is valid from ``valid_from`` (included) to ``valid_to`` (excluded;
    NULL: still open).  Facts without a key, a time or a valid version get NULLs
    and are dropped by an inner join.  Versions without a key or a start are
    never valid.  The versions of a key must not overlap or start together, as
    in a type-2 history.
    """
    if how not in ("left", "inner"):
        raise ValueError("as-of joins are left or inner")
    clash = set(columns) & set(facts.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    keys = list(keys)
    held = F.struct(F.col(valid_to).alias("_until"), *[F.col(c) for c in columns])
    started = versions.filter(F.col(valid_from).isNotNull())
    for k in keys:
        started = started.filter(F.col(k).isNotNull())
    # At one moment the version comes first: it is valid from that moment on.
    begun = started.select(*keys, F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), held.alias("_version"))
    rows = facts.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct("*").alias("_fact"))
    line = rows.unionByName(begun, allowMissingColumns=True)
    met = fill_by(line, keys, [("_at", "asc"), ("_kind", "asc")], "_version", "_met", rows_per_task)
    valid = F.col("_at").isNotNull() & (F.col("_met._until").isNull() | (F.col("_at") < F.col("_met._until")))
    out = met.filter("_kind = 1").withColumn("_valid", F.col("_met").isNotNull() & valid)
    if how == "inner":
        out = out.filter("_valid")
    return out.select("_fact.*", *[F.when(F.col("_valid"), F.col(f"_met.{c}")).alias(c) for c in columns])
