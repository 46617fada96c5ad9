"""Column helpers on literal rows."""

from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gildstar.functions.keys import NULL_TOKEN, date_key, default_key, surrogate_key
from gildstar.functions.ordering import reverse_columns, sort_columns, sorts_before
from gildstar.functions.scalars import (
    band,
    band_below,
    category,
    cents_to_money,
    coalesce_priority,
    contains_text,
    count_true,
    csv_element,
    midpoint,
    parse_range,
    pct_change,
    safe_ratio,
    try_number,
)
from gildstar.plans.intermediate import PRICE_BANDS, REVIEW_BANDS
from gildstar.plans.staging import DIFFICULTY_BANDS


def values(spark, schema, rows, *columns):
    df = spark.createDataFrame(rows, schema).select(*columns)
    return [tuple(r) for r in df.collect()]


def test_money(spark):
    got = values(spark, "c long", [(999,), (0,), (None,), (1,)], cents_to_money("c"))
    assert [g[0] for g in got] == [Decimal("9.99"), Decimal("0"), None, Decimal("0.01")]


def test_ratio_guards_zero_and_null(spark):
    rows = [(1, 4), (0, 0), (None, 4), (3, None)]
    assert [g[0] for g in values(spark, "a long, b long", rows, safe_ratio("a", "b"))] == [0.25, None, None, None]


def test_pct_change(spark):
    rows = [(110, 100), (5, 0), (5, None), (None, 5), (90, 100), (-3, -2)]
    got = [g[0] for g in values(spark, "a long, b long", rows, pct_change("a", "b"))]
    assert got == [10.0, None, None, None, -10.0, 50.0]


def test_midpoint(spark):
    assert [g[0] for g in values(spark, "a long, b long", [(1, 2), (None, 2), (1, None)], midpoint("a", "b"))] == [1.5, None, None]


def test_try_number_rounds_half_up(spark):
    rows = [("12",), ("1.5",), ("",), ("n/a",), (None,), (" 7 ",)]
    assert [g[0] for g in values(spark, "t string", rows, try_number("t"))] == [12, 2, None, None, None, 7]


def test_range(spark):
    rows = [("10,000,000 .. 20,000,000",), ("0 .. 20,000",), ("n/a",), ("5000",), (None,), ("1 .. x",)]
    got = values(spark, "t string", rows, *parse_range("t"))
    assert got == [(10000000, 20000000), (0, 20000), (None, None), (5000, None), (None, None), (1, None)]


def test_csv_element(spark):
    rows = [("Action, Free To Play, ",), ("",), (None,)]
    got = values(spark, "t string", rows, csv_element("t", 1), csv_element("t", 2), csv_element("t", 5))
    assert got == [("Action", "Free To Play", ""), ("", "", ""), (None, None, None)]


@pytest.mark.parametrize(
    "value, label",
    [(50.0, "common"), (49.99, "uncommon"), (20.0, "uncommon"), (5.0, "rare"), (4.9, "ultra_rare"), (None, "ultra_rare")],
)
def test_descending_band(spark, value, label):
    assert values(spark, "v double", [(value,)], band("v", DIFFICULTY_BANDS, "ultra_rare")) == [(label,)]


@pytest.mark.parametrize(
    "score, label",
    [
        (0.95, "Overwhelmingly Positive"),
        (0.85, "Very Positive"),
        (0.70, "Mostly Positive"),
        (0.40, "Mixed"),
        (0.20, "Mostly Negative"),
        (0.19, "Overwhelmingly Negative"),
        (None, "Overwhelmingly Negative"),
    ],
)
def test_review_bands(spark, score, label):
    assert values(spark, "v double", [(score,)], band("v", REVIEW_BANDS, "Overwhelmingly Negative")) == [(label,)]


def test_ascending_band_with_override(spark):
    rows = [(0, False), (0, True), (499, False), (500, False), (1999, False), (2000, False), (3999, False), (4000, False), (None, False), (None, True)]
    price = cents_to_money("c")
    got = values(spark, "c long, free boolean", rows, band_below(price, PRICE_BANDS, "aaa", (F.col("free"), "free")))
    assert [g[0] for g in got] == ["budget", "free", "budget", "mid", "mid", "premium", "premium", "aaa", "aaa", "free"]


def test_category_merge_flags_and_text(spark):
    groups = {"x": ["a", "b"], "y": ["c"]}
    assert values(spark, "v string", [("a",), ("c",), ("z",), (None,)], category("v", groups, "o")) == [("x",), ("y",), ("o",), ("o",)]
    assert values(spark, "a string, b string", [(None, "2"), ("1", "2")], *coalesce_priority({"n": ["a", "b"]})) == [("2",), ("1",)]
    rows = [(True, None, True), (None, None, None), (False, True, False)]
    assert values(spark, "a boolean, b boolean, c boolean", rows, count_true("a", "b", "c")) == [(2,), (0,), (1,)]
    assert values(spark, "t string", [("An INDIE one",), (None,), ("x",)], contains_text("t", "indie")) == [(True,), (False,), (False,)]


def test_surrogate_key_is_null_safe(spark):
    rows = [(1, "x"), (1, None)]
    got = [g[0] for g in values(spark, "a long, b string", rows, surrogate_key("a", "b"))]
    want = [hashlib.md5(t.encode()).hexdigest() for t in ("1-x", f"1-{NULL_TOKEN}")]
    assert got == want
    assert values(spark, "a long", [(1,)], default_key()) == [(hashlib.md5(b"Unknown").hexdigest(),)]


def test_date_key(spark):
    rows = [(datetime(2030, 12, 31, 23, 59, 59), date(2024, 1, 2)), (None, None)]
    assert values(spark, "t timestamp_ntz, d date", rows, date_key("t"), date_key("d")) == [(20301231, 20240102), (None, None)]


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize(
    "schema, cells",
    [
        ("long", [3, 1, None, 2, -5]),
        ("double", [0.5, -0.25, None, 9.0]),
        ("timestamp_ntz", [datetime(2024, 3, 31, 2, 30), None, datetime(1969, 1, 1), datetime(2024, 10, 27, 2, 30)]),
        ("date", [date(2024, 1, 1), None, date(1950, 5, 5)]),
        ("boolean", [True, None, False]),
        ("string", ["b", None, "a", ""]),
    ],
)
def test_sorts_before_agrees_with_the_sort(spark, schema, cells, direction):
    df = spark.createDataFrame([(c,) for c in cells], f"v {schema}")
    order = [("v", direction)]
    listed = [r[0] for r in df.orderBy(*sort_columns(order)).collect()]
    assert [r[0] for r in df.orderBy(*reverse_columns(order)).collect()] == listed[::-1]
    a, b = df.select(F.col("v").alias("a")), df.select(F.col("v").alias("b"))
    pairs = a.crossJoin(b).select("a", "b", sorts_before([F.col("a")], [F.col("b")], order).alias("before")).collect()
    assert all(r.before == (listed.index(r.a) < listed.index(r.b)) for r in pairs)


def test_unknown_direction_is_refused():
    with pytest.raises(ValueError):
        sort_columns([("v", "up")])
