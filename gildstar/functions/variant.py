"""Typed reads from VARIANT payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(payload: ColumnOrName, path: str, dtype: str, on_error: str = "fail") -> Column:
    """``payload:path::dtype``; missing path and JSON null give NULL.

    ``dtype="variant"`` keeps the sub-document.  ``on_error="null"`` turns a
    value of the wrong shape into NULL instead of failing.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    get = "variant_get" if on_error == "fail" else "try_variant_get"
    if isinstance(payload, str):
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        return F.expr(f"{get}(`{payload}`, '{quoted}', '{dtype}')")
    return getattr(F, get)(payload, path, dtype)


def elements(payload: ColumnOrName, path: str) -> Column:
    """The array at ``path`` as array<variant>; NULL if it is no array."""
    return F.try_variant_get(_col(payload), path, "array<variant>")


def entries(payload: ColumnOrName, path: str, value_type: str) -> Column:
    """The object at ``path`` as an array of (key, value), values cast.

    NULL if there is no object there.  Values are cast strictly, so a bad one
    fails rather than vanishes.
    """
    pairs = F.map_entries(F.try_variant_get(_col(payload), path, "map<string,variant>"))
    return F.transform(
        pairs,
        lambda e: F.struct(
            e["key"].alias("key"), F.variant_get(e["value"], "$", value_type).alias("value")
        ),
    )


def array_has(payload: ColumnOrName, path: str, key: str, literal: str) -> Column:
    """Does some object in the array carry ``key = literal``?  Never NULL."""
    hit = F.exists(
        elements(payload, path),
        lambda e: F.coalesce(
            F.try_variant_get(e, f"$.{key}", "string") == F.lit(literal), F.lit(False)
        ),
    )
    return F.coalesce(hit, F.lit(False))


def top_keys(payload: ColumnOrName, path: str, k: int, separator: str = ", ") -> Column:
    """W4+G5 inside one object: the k keys with the largest values, joined.

    Order is value descending with NULLs first, then key.  The object sits in
    one row, so no shuffle is needed.  '' for an empty object, NULL for no object.
    """
    ranked = F.array_sort(
        F.transform(
            entries(payload, path, "bigint"),
            lambda e: F.struct(
                F.when(e["value"].isNull(), 0).otherwise(1).alias("n"),
                (-e["value"]).alias("v"),
                e["key"].alias("key"),
            ),
        )
    )
    return F.array_join(F.transform(F.slice(ranked, 1, k), lambda e: e["key"]), separator)
