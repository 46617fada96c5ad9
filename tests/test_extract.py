"""Payload reads: paths, quoted numbers, sub-documents, arrays and objects."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gildstar.functions.variant import array_has, field, top_keys
from gildstar.operators.extract import explode_array, explode_object, extract
from gildstar.sources.bronze import as_variant, land_bronze, read_bronze


def docs(spark, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return as_variant(spark.createDataFrame(rows, "id int, doc string"), "doc")


def test_scalar_paths(spark):
    df = docs(spark, '{"a":"999","b":{"c":true},"d":["x","y"],"e":null}', '{"a":7,"d":[]}', None)
    got = extract(
        df,
        "doc",
        {"a": ("$.a", "bigint"), "c": ("$.b.c", "boolean"), "d": ("$.d[0]", "string"), "e": ("$.e", "string")},
        keep=["id"],
    )
    assert got.columns == ["a", "c", "d", "e", "id"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (999, True, "x", None, 0),
        (7, None, None, None, 1),
        (None, None, None, None, 2),
    ]


def test_bad_values_fail_or_become_null(spark):
    df = docs(spark, '{"a":"abc"}')
    with pytest.raises(PySparkException):
        extract(df, "doc", {"a": ("$.a", "bigint")}).collect()
    assert extract(df, "doc", {"a": ("$.a", "bigint")}, on_error="null").collect()[0][0] is None
    with pytest.raises(ValueError):
        field("doc", "$.a", "bigint", on_error="ignore")


def test_explode_array_drops_parents_without_one(spark):
    df = docs(
        spark,
        '{"l":[{"n":"a","p":1.5},{"n":"b"}]}',
        '{"l":[]}',
        '{"l":null}',
        '{"l":{"n":"x"}}',
        "{}",
        None,
    )
    got = explode_array(df, "doc", "$.l", {"n": ("$.n", "string"), "p": ("$.p", "double")}, keep=["id"])
    assert sorted(tuple(r) for r in got.collect()) == [(0, "a", 1.5), (0, "b", None)]


def test_explode_object_drops_non_objects(spark):
    df = docs(spark, '{"t":{"x":"3","y":4,"z":null}}', '{"t":{}}', '{"t":[]}', '{"t":null}', '{"t":5}', "{}")
    got = explode_object(df, "doc", "bigint", "$.t", keep=["id"])
    assert sorted(((r.id, r.key, r.value) for r in got.collect()), key=str) == [(0, "x", 3), (0, "y", 4), (0, "z", None)]


def test_explode_object_fails_on_a_bad_value(spark):
    with pytest.raises(PySparkException):
        explode_object(docs(spark, '{"t":{"x":"many"}}'), "doc", "bigint", "$.t").collect()


def test_array_has_is_never_null(spark):
    df = docs(
        spark,
        '{"g":[{"description":"Action"},{"description":"Early Access"}]}',
        '{"g":[{"description":"Action"},{"id":1}]}',
        '{"g":["Early Access"]}',
        '{"g":[]}',
        '{"g":null}',
        "{}",
        None,
    )
    got = df.select("id", array_has("doc", "$.g", "description", "Early Access")).orderBy("id").collect()
    assert [r[1] for r in got] == [True, False, False, False, False, False, False]


def test_top_keys_breaks_ties_by_name(spark):
    df = docs(
        spark,
        '{"t":{"g":1,"f":2,"e":2,"d":2,"c":2,"b":2,"a":9}}',
        '{"t":{"x":"10","y":9}}',
        '{"t":{"x":1,"y":null}}',
        '{"t":{}}',
        '{"t":[]}',
        "{}",
    )
    got = [r[1] for r in df.select("id", top_keys("doc", "$.t", 5)).orderBy("id").collect()]
    assert got == ["a, b, c, d, e", "x, y", "y, x", "", None, None]


def test_landed_bronze_reads_back(spark, tmp_path):
    df = spark.createDataFrame(
        [("l1", "2024-01-01 10:00:00", '{"k":1}'), ("l2", "2024-01-02 10:00:00", None)],
        "load_id string, at string, raw_data string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    for compact in (False, True):
        path = str(tmp_path / f"b{compact}")
        landed = land_bronze(df, path, day_of="at", compact=compact)
        back = read_bronze(spark, path)
        assert sorted(landed.columns) == sorted(back.columns)
        got = back.select("load_id", "at_day", field("raw_data", "$.k", "int")).orderBy("load_id").collect()
        assert [tuple(r) for r in got] == [("l1", 20240101, 1), ("l2", 20240102, None)]
