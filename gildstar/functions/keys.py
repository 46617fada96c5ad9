"""Surrogate, default and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token that stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the ``-``-joined text of the columns, NULL-safe."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *texts))


def default_key(member: str = "Unknown") -> Column:
    """Key of a named default member."""
    return F.md5(F.lit(member))


def date_key(moment: Column | str) -> Column:
    """DATE or zone-less timestamp to the integer YYYYMMDD."""
    day = (F.col(moment) if isinstance(moment, str) else moment).cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
