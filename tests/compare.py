"""Run a registered query and its SQL counterpart, and compare them as the checks do."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(con, df, sql: str) -> str | None:
    """None if both sides agree, else a short description."""
    got_types = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(got_types) != sorted(want_types):
        return f"columns differ: {sorted(set(got_types) ^ set(want_types))}"
    if got_types != {k: want_types[k] for k in got_types}:
        bad = {k: (got_types[k], want_types[k]) for k in got_types if got_types[k] != want_types[k]}
        return f"types differ (spark, sql): {bad}"
    a = _rows(list(got_types), got)
    b = _rows(list(want_types), want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        return f"rows differ: {len(a)} vs {len(b)}; spark only {only_a}; sql only {only_b}"
    if not a:
        return "no rows"
    return None
