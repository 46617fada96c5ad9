"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.scalars import contains_text
from gildstar.operators.aggregates import (
    any_true,
    concat_ordered,
    distinct_members,
    overall_max,
    rollup_by,
    rounded_avg,
)
from gildstar.operators.dedupe import top_k_per_group
from gildstar.queries.dataflows import details, snapshots
from gildstar.queries.registry import bronze, publish, register, table
from gildstar.queries.sqltext import with_ctes


@register(
    "G1_G4_rollup",
    """SELECT p_brand, count(*) AS n_parts, CAST(sum(p_size) AS BIGINT) AS total_size, max(p_type) AS any_type,
              round(avg(p_size), 3) AS avg_size, bool_or(p_name ILIKE '%Ring%') AS has_ring
       FROM part GROUP BY p_brand""",
)
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, sum, average, representative text and any-true per brand."""
    return rollup_by(
        table(spark, sf_dir, "part"),
        ["p_brand"],
        n_parts=F.count(F.lit(1)),
        total_size=F.sum("p_size"),
        any_type=F.max("p_type"),
        avg_size=rounded_avg("p_size", 3),
        has_ring=any_true(contains_text("p_name", "Ring")),
    )


@register(
    "G1_order_rollup",
    """SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS spent,
              max(o_orderpriority) AS any_priority, bool_or(o_orderstatus = 'F') AS any_filled
       FROM orders GROUP BY o_custkey""",
)
def order_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_by(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        n_orders=F.count(F.lit(1)),
        spent=F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"),
        any_priority=F.max("o_orderpriority"),
        any_filled=any_true(F.col("o_orderstatus") == "F"),
    )


@register(
    "G5_ordered_text",
    """SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_extendedprice DESC, l_partkey) AS parts
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS FIRST, l_partkey)
                    AS rn FROM lineitem)
       WHERE rn <= 5 GROUP BY l_orderkey""",
)
def ordered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dearest parts of each order as text, dearest first."""
    order = [("l_extendedprice", "desc"), ("l_partkey", "asc")]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    top = top_k_per_group(lines, ["l_orderkey"], order, 5)
    named = top.withColumn("part", F.col("l_partkey").cast("string"))
    return named.groupBy("l_orderkey").agg(concat_ordered("part", order).alias("parts"))


@register(
    "G6_S1_distinct_members",
    """SELECT DISTINCT trim(w) AS word FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE trim(w) <> ''""",
)
def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_members(table(spark, sf_dir, "part"), "p_name", "word", " ")


@register(
    "G6_distinct_genres",
    with_ctes("d_rows")
    + """SELECT DISTINCT trim(g) AS genre FROM (SELECT unnest(string_split(genres, ',')) AS g FROM d_rows)
         WHERE trim(g) <> ''""",
)
def distinct_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(spark, sf_dir, "raw_details").select(F.expr("raw_data:genre::string").alias("genres"))
    return distinct_members(rows, "genres", "genre")


@register(
    "G7_overall_max_fallback",
    with_ctes("stg_details", "players")
    + """SELECT d.app_id, coalesce(p.seen_at, (SELECT max(snapshot_at) FROM players)) AS snapshot_at
         FROM stg_details d
         LEFT JOIN (SELECT app_id, max(snapshot_at) AS seen_at FROM players GROUP BY app_id) p ON p.app_id = d.app_id""",
)
def max_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table-wide maximum fills in for games without a snapshot."""
    latest = rollup_by(snapshots(spark, sf_dir), ["app_id"], seen_at=F.max("snapshot_at"))
    games = details(spark, sf_dir).select("app_id")
    filled = F.coalesce(F.col("seen_at"), overall_max(latest, "seen_at"))
    return games.join(latest, "app_id", "left").select("app_id", filled.alias("snapshot_at"))


@register(
    "G8_high_water",
    """SELECT event_type, max(ts) AS high_water, (SELECT max(ts) FROM events) AS overall,
              (SELECT max(ts) FROM events) = max(ts) AS is_newest
       FROM events GROUP BY event_type""",
)
def high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    marks = rollup_by(events, ["event_type"], high_water=F.max("ts"))
    overall = overall_max(marks, "high_water")
    return marks.select(
        "event_type",
        "high_water",
        overall.alias("overall"),
        (F.col("high_water") == overall).alias("is_newest"),
    )
