"""Type-2 history of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.keys import date_key, surrogate_key
from gildstar.operators.filters import null_of
from gildstar.operators.incremental import Target, again, load_batch, load_full, read_target
from gildstar.sources import versions

VALIDITY = ("valid_from", "valid_to", "is_current")

# Partition column of a stored history: the day a version closed, 0 while it is open.
CLOSED_DAY = "closed_day"
OPEN = 0


def scd2_start(
    snapshot: DataFrame, keys: Sequence[str], effective: str, version_key: str = "version_key"
) -> DataFrame:
    """First load: every row of the snapshot opens a version."""
    opened = snapshot.withColumnRenamed(effective, "valid_from").withColumns(
        {"valid_to": null_of("timestamp_ntz"), "is_current": F.lit(True)}
    )
    return opened.select(surrogate_key(*keys, "valid_from").alias(version_key), "*")


def scd2_changes(
    current: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    version_key: str = "version_key",
) -> DataFrame:
    """The open versions after a snapshot, plus the ones it closed.

    ``current`` holds the open versions, ``snapshot`` one row per key with the
    time ``effective`` at which it was seen.  A tracked column that differs
    (NULL-safe) closes the old version and opens a new one; a snapshot that is
    not newer than the open version changes nothing; keys missing from the
    snapshot stay open.

    One full outer join; each joined pair then emits its one or two rows.
    """
    keys = list(keys)
    attributes = [c for c in current.columns if c not in (version_key, *keys, *VALIDITY)]
    old = current.select(*keys, F.struct(*current.columns).alias("_old"))
    new_version = F.struct(
        surrogate_key(*keys, effective).alias(version_key),
        *[F.col(k) for k in keys],
        *[F.col(a) for a in attributes],
        F.col(effective).alias("valid_from"),
        null_of("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    ordered = F.struct(*[F.col(f"_new.{c}").alias(c) for c in current.columns])
    new = snapshot.select(*keys, new_version.alias("_new")).select(*keys, ordered.alias("_new"))

    both = old.join(new, keys, "full_outer").select("_old", "_new")
    changed: Column = F.lit(False)
    for column in tracked:
        changed = changed | ~F.col(f"_old.{column}").eqNullSafe(F.col(f"_new.{column}"))
    supersedes = (
        F.col("_new").isNotNull() & changed & (F.col("_new.valid_from") > F.col("_old.valid_from"))
    )
    closed = (
        F.col("_old").withField("valid_to", F.col("_new.valid_from")).withField("is_current", F.lit(False))
    )
    rows = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(supersedes, F.array(closed, F.col("_new")))
        .otherwise(F.array("_old"))
    )
    return both.select(F.explode(rows).alias("_row")).select("_row.*")


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    version_key: str = "version_key",
) -> DataFrame:
    """The whole history after a snapshot; closed versions pass through untouched.

    ``history`` should be a stored table, best partitioned by ``is_current``: it
    is read twice, once for the open and once for the closed versions.
    """
    changed = scd2_changes(
        history.filter("is_current"), snapshot, keys, tracked, effective, version_key
    )
    return history.filter("NOT is_current").unionByName(changed)


def history_target(path: str, version_key: str = "version_key") -> Target:
    """A stored history, one partition for open versions and one per closing day."""
    return Target(path, [version_key], "valid_from", CLOSED_DAY)


def load_scd2(
    spark: SparkSession,
    snapshot: DataFrame,
    target: Target,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
) -> DataFrame:
    """Bring a stored history up to date and return it.

    Rewrites the open versions and the days on which versions close now; older
    closed versions are neither read nor written.  Loading the same snapshot
    again changes nothing.  Of two loads at once the later one compares its
    snapshot with what the other left.
    """
    version_key = target.keys[0]

    def dated(rows: DataFrame) -> DataFrame:
        day = F.when(F.col("is_current"), F.lit(OPEN)).otherwise(date_key("valid_to"))
        return rows.withColumn(CLOSED_DAY, day)

    def once() -> DataFrame:
        number, _ = versions.current(spark, target.path)
        if not number:
            return load_full(spark, dated(scd2_start(snapshot, keys, effective, version_key)), target, first=True)
        current = read_target(spark, target, number, days=[OPEN]).drop(CLOSED_DAY)
        changes = scd2_changes(current, snapshot, keys, tracked, effective, version_key)
        return load_batch(spark, dated(changes), target, replaced=frozenset({OPEN}), expected=number)

    return again(once)
