"""Latest row, top-k, and the skew-safe lag, rank and lookup against plain windows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gildstar.functions.ordering import sort_columns
from gildstar.operators.dedupe import latest_per_key, top_k_per_group
from gildstar.operators.joins import Dim, lookup, star_join
from gildstar.operators.series import fill_by, lag_by, rank_by
from gildstar.operators.skew import MAX_SLICES_PER_KEY, hot_keys, slice_hot_keys


@pytest.fixture(scope="module")
def skewed(spark):
    """One key owns a third of the rows, NULL keys a sixth; orders hold NULLs and ties."""
    rnd = random.Random(5)
    rows = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{rnd.randrange(200)}"
        at = None if rnd.random() < 0.02 else datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(900))
        rows.append((key, at, i, None if rnd.random() < 0.1 else rnd.random(), f"n{rnd.randrange(40):02d}"))
    return spark.createDataFrame(rows, "k string, at timestamp_ntz, id long, v double, name string").cache()


def same(a, b):
    left = sorted((tuple(r) for r in a.select(*sorted(a.columns)).collect()), key=str)
    right = sorted((tuple(r) for r in b.select(*sorted(b.columns)).collect()), key=str)
    assert left == right


ORDERS = [
    [("at", "asc"), ("id", "asc")],
    [("at", "desc"), ("id", "desc")],
    [("v", "desc"), ("name", "asc"), ("id", "asc")],
    [("name", "asc"), ("id", "desc")],
    [("name", "desc"), ("v", "asc"), ("id", "asc")],
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("rows_per_task", [7, 100, 1000])
def test_lag_equals_plain_window(skewed, order, rows_per_task):
    want = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy(*sort_columns(order))))
    same(lag_by(skewed, ["k"], order, "v", "p", rows_per_task), want)


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("rows_per_task", [7, 100, 1000])
def test_rank_equals_plain_window(skewed, order, rows_per_task):
    want = skewed.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*sort_columns(order))))
    same(rank_by(skewed, ["k"], order, "r", rows_per_task), want)


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("rows_per_task", [7, 1000])
def test_fill_equals_plain_window(skewed, order, rows_per_task):
    sparse = skewed.withColumn("w", F.when(F.col("id") % 97 == 0, F.col("id")))
    up_to = Window.partitionBy("k").orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    want = sparse.withColumn("p", F.last("w", ignorenulls=True).over(up_to))
    same(fill_by(sparse, ["k"], order, "w", "p", rows_per_task), want)


def test_most_rows_of_a_task_are_bounded(spark, skewed):
    """No slice of a hot key is larger than a task's share, at any number of partitions."""
    for rows_per_task in (50, 200, 400):
        fair = max(rows_per_task, 6000 // 8)
        for order in ORDERS:
            sliced, _ = slice_hot_keys(skewed, ["k"], order, rows_per_task)
            assert max(r["count"] for r in sliced.groupBy("k", "_slice").count().collect()) <= fair


def test_two_key_columns(skewed):
    keyed = skewed.withColumn("h", F.col("id") % 2)
    order = [("at", "asc"), ("id", "asc")]
    window = Window.partitionBy("k", "h").orderBy(*sort_columns(order))
    same(lag_by(keyed, ["k", "h"], order, "v", "p", 50), keyed.withColumn("p", F.lag("v").over(window)))
    same(rank_by(keyed, ["k", "h"], order, "r", 50), keyed.withColumn("r", F.row_number().over(window)))


def test_slices_split_the_hot_key_evenly(skewed):
    order = [("at", "asc"), ("id", "asc")]
    sliced, hot = slice_hot_keys(skewed, ["k"], order, 100)
    sizes = [r["count"] for r in hot.filter("k = 'hot'").groupBy("_slice").count().collect()]
    assert sum(sizes) == 2000 and len(sizes) >= 15 and max(sizes) < 300
    assert sliced.filter("k LIKE 'k%'").select("_slice").distinct().collect() == [(0,)]
    by_slice = hot.groupBy("k", "_slice").agg(
        F.min(F.struct(F.col("at").isNull(), "at", "id")).alias("lo"), F.max(F.struct(F.col("at").isNull(), "at", "id")).alias("hi")
    )
    overlap = by_slice.alias("a").join(
        by_slice.alias("b"), F.expr("a.k <=> b.k AND a._slice < b._slice AND a.hi >= b.lo")
    )
    assert overlap.count() == 0


def test_one_value_tied_throughout(spark):
    df = spark.range(500).select(F.lit("a").alias("k"), F.lit(1).alias("v"), "id")
    order = [("v", "asc"), ("id", "asc")]
    sliced, _ = slice_hot_keys(df, ["k"], order, 50)
    assert sliced.select("_slice").distinct().count() >= 5
    same(rank_by(df, ["k"], order, "r", 50), df.withColumn("r", (F.col("id") + 1).cast("int")))


def test_no_hot_key_leaves_the_plan_alone(skewed):
    assert slice_hot_keys(skewed, ["k"], ORDERS[0], 3000) is None  # rows are many, but no key has so many
    assert slice_hot_keys(skewed, ["k"], ORDERS[0], 6000) is None
    assert slice_hot_keys(skewed, ["k"], ORDERS[0]) is None


def test_hot_keys_are_bounded_by_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert len(hot_keys(df, ["k"], 1)) == 8
    assert MAX_SLICES_PER_KEY & (MAX_SLICES_PER_KEY - 1) == 0


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, at long, v double")
    assert lag_by(df, ["k"], [("at", "asc")], "v", "p", 1).count() == 0
    assert rank_by(df, ["k"], [("at", "asc")], "r", 1).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_plain_join(skewed, how):
    right = skewed.filter("k IS NOT NULL AND k <> 'k7'").groupBy("k").agg(F.max("v").alias("best"))
    want = skewed.join(right, "k", how)
    same(lookup(skewed, right, ["k"], how, rows_per_task=50, broadcast_bytes=0), want)
    same(lookup(skewed, right, ["k"], how), want)


def test_salted_lookup_spreads_the_hot_key(spark, skewed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = skewed.groupBy("k").agg(F.max("v").alias("best"))
        joined = lookup(skewed, right, ["k"], "left", rows_per_task=100)
        tasks = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 3 and sum(t["count"] for t in tasks) == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_refuses_other_joins(skewed):
    with pytest.raises(ValueError):
        lookup(skewed, skewed, ["k"], "full")


def test_star_join_defaults_and_filters(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", 10, True), ("b", 20, False)], "code string, code_key int, live boolean")
    got = star_join(fact, [Dim(dim, "code", "code_key", F.upper(F.lower("code")), F.lit(-1), where=F.col("live"))])
    assert got.count() == 3 and got.filter("code_key <> -1").count() == 0
    got = star_join(fact, [Dim(dim, "code", "code_key", F.col("code"), F.lit(-1), where=F.col("live"))])
    assert sorted(tuple(r) for r in got.select("id", "code_key").collect()) == [(1, 10), (2, -1), (3, -1)]


def test_latest_row_null_time_wins_and_ties_break(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (2, None, "c"), (2, "2024-01-02", "d"),
         (3, "2024-01-01", "e"), (3, "2024-01-01", "f"), (None, "2024-01-01", "g")],
        "k int, at string, load string",
    )
    got = latest_per_key(df, ["k"], [("at", "desc"), ("load", "desc")])
    assert rows(got.select("k", "load")) == [(1, "b"), (2, "c"), (3, "f")]


def test_top_k_keeps_rank_on_request(spark, rows):
    df = spark.createDataFrame([("a", i, i % 2) for i in range(6)], "k string, v int, w int")
    top = top_k_per_group(df, ["k"], [("v", "desc")], 2, "rank")
    assert rows(top.select("v", "rank")) == [(4, 2), (5, 1)]
    assert "_rank" not in top_k_per_group(df, ["k"], [("v", "desc")], 2).columns
