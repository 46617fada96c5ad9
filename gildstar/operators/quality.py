"""Data-quality checks over tables.

A check yields the number of failing rows.  ``run_checks`` folds all row-level
checks of a table (not_null, accepted_values, between) into one aggregation
pass; each uniqueness check and each foreign key is a grouped job of its own,
partially aggregated before it shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildstar.operators.filters import require


@dataclass(frozen=True)
class Check:
    """One declared check of one column."""

    model: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships | between
    values: Sequence = ()
    low: float | None = None
    high: float | None = None
    parent: str | None = None
    parent_column: str | None = None


# --- predicates of failing rows -------------------------------------------


def fails_not_null(column: str) -> Column:
    return F.col(column).isNull()


def fails_accepted(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def fails_between(column: str, low: float | None = None, high: float | None = None) -> Column:
    """NULL passes; bounds are inclusive."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return F.col(column).isNotNull() & outside


# --- failing rows ----------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is NULL."""
    return df.filter(fails_not_null(column))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    return (
        require(df, *columns)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose non-NULL value is not in the list."""
    return df.filter(fails_accepted(column, values))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """C4: orphaned child values with their number of rows.

    Counting per value first keeps a hot value from piling up in the join.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_fk"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    keys = parent.select(F.col(parent_column).alias("_fk"))
    return values.join(keys, "_fk", "left_anti").withColumnRenamed("_fk", column)


def between(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows outside the inclusive range; NULL passes."""
    return df.filter(fails_between(column, low, high))


def reconcile(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows in which two sources of one number disagree (NULL-safe)."""
    return df.filter(~F.col(left).eqNullSafe(F.col(right)))


# --- suite -----------------------------------------------------------------


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(model, column_name, check_kind, n_failed) for every check."""
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        mine = [c for c in checks if c.model == model]
        per_row = [c for c in mine if c.kind in ("not_null", "accepted_values", "between")]
        if per_row:
            parts.append(_row_checks(tables[model], per_row))
        for check in mine:
            if check.kind == "unique":
                failing = unique(tables[model], check.column)
                parts.append(_labelled(failing.agg(F.count(F.lit(1)).alias("n")), check))
            elif check.kind == "relationships":
                orphans = foreign_key(
                    tables[model], check.column, tables[check.parent], check.parent_column
                )
                total = F.coalesce(F.sum("n_records"), F.lit(0)).alias("n")
                parts.append(_labelled(orphans.agg(total), check))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    predicate = {
        "not_null": lambda c: fails_not_null(c.column),
        "accepted_values": lambda c: fails_accepted(c.column, c.values),
        "between": lambda c: fails_between(c.column, c.low, c.high),
    }
    counts = df.agg(
        *[F.count_if(predicate[c.kind](c)).alias(f"c{i}") for i, c in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.model).alias("model"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.kind).alias("check_kind"),
                F.col(f"c{i}").alias("n_failed"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def _labelled(one_row: DataFrame, check: Check) -> DataFrame:
    return one_row.select(
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_kind"),
        F.col("n").cast("bigint").alias("n_failed"),
    )
