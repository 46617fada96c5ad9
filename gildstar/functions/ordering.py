"""Sort orders with the null placement the data model expects.

Ascending puts NULLs last and descending puts them first, which is the
opposite of Spark's defaults, so every ordering is spelled out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Order = Sequence[tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    """``[("ts", "desc"), ("id", "asc")]`` -> Spark sort expressions."""
    out = []
    for name, direction in order:
        if direction == "asc":
            out.append(F.col(name).asc_nulls_last())
        elif direction == "desc":
            out.append(F.col(name).desc_nulls_first())
        else:
            raise ValueError(f"order direction must be asc or desc, got {direction!r}")
    return out


def reverse_columns(order: Order) -> list[Column]:
    """The sort expressions that list the same rows backwards."""
    back = {"asc": "desc", "desc": "asc"}
    return sort_columns([(name, back.get(direction, direction)) for name, direction in order])


def sorts_before(left: Sequence[Column], right: Sequence[Column], order: Order) -> Column:
    """Does a row of values ``left`` come before a row of values ``right`` along ``order``?  Rows that tie do not.

    Values are compared as they are, so any sortable type works in either direction.
    """
    before, tied = F.lit(False), F.lit(True)
    for a, b, (_, direction) in zip(left, right, order):
        if direction == "asc":
            first = a.isNotNull() & (b.isNull() | F.coalesce(a < b, F.lit(False)))
        else:
            first = b.isNotNull() & (a.isNull() | F.coalesce(a > b, F.lit(False)))
        before = before | (tied & first)
        tied = tied & a.eqNullSafe(b)
    return before
