"""Bronze payload to typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildstar.functions.variant import elements, entries, field

Fields = Mapping[str, tuple[str, str]]


def extract(
    df: DataFrame,
    payload: str,
    fields: Fields,
    keep: Sequence[Column | str] = (),
    on_error: str = "fail",
) -> DataFrame:
    """Project ``{name: (path, type)}`` out of a VARIANT column.

    All reads sit in one projection, so over a stored VARIANT they are pushed
    into the Parquet scan together.
    """
    columns = [field(payload, path, dtype, on_error).alias(name) for name, (path, dtype) in fields.items()]
    return df.select(*columns, *keep)


def explode_array(
    df: DataFrame,
    payload: str,
    path: str,
    fields: Fields,
    keep: Sequence[Column | str] = (),
    on_error: str = "fail",
) -> DataFrame:
    """One row per array element; parents without an array vanish."""
    rows = df.select(*keep, F.explode(elements(payload, path)).alias("_element"))
    kept = [c for c in rows.columns if c != "_element"]
    read = [field("_element", p, t, on_error).alias(name) for name, (p, t) in fields.items()]
    return rows.select(*kept, *read)


def explode_object(
    df: DataFrame,
    payload: str,
    value_type: str,
    path: str = "$",
    keep: Sequence[Column | str] = (),
    key_name: str = "key",
    value_name: str = "value",
) -> DataFrame:
    """One row per (key, value) of a JSON object; non-objects vanish."""
    rows = df.select(*keep, F.explode(entries(payload, path, value_type)).alias("_entry"))
    kept = [c for c in rows.columns if c != "_entry"]
    return rows.select(
        *kept, F.col("_entry.key").alias(key_name), F.col("_entry.value").alias(value_name)
    )
