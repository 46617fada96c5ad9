"""Window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.variant import top_keys
from gildstar.operators.aggregates import concat_ordered
from gildstar.operators.dedupe import latest_per_key, top_k_per_group
from gildstar.operators.extract import explode_object
from gildstar.operators.series import lag_by, rank_by
from gildstar.queries.dataflows import achievements, snapshots
from gildstar.queries.registry import bronze, publish, register, table
from gildstar.queries.sqltext import with_ctes

# Small enough that the handful of event types count as hot at every scale.
_FEW_ROWS = 50


@register(
    "W1_latest_per_key",
    """SELECT user_id, event_id, ts, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1""",
)
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], [("ts", "desc"), ("event_id", "desc")])


@register(
    "W1_latest_load_ties",
    with_ctes("d_rows")
    + """SELECT app_id, load_id, _ingested_at FROM d_rows WHERE app_id IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY _ingested_at DESC NULLS FIRST, load_id DESC) = 1""",
)
def latest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL and equal ingestion times: NULL sorts first, the load id breaks ties."""
    loads = bronze(spark, sf_dir, "raw_details").select(
        F.expr("raw_data:appid::bigint").alias("app_id"),
        "load_id",
        F.col("ingested_at").alias("_ingested_at"),
    )
    return latest_per_key(loads, ["app_id"], [("_ingested_at", "desc"), ("load_id", "desc")])


@register(
    "W2_W3_latest_snapshot",
    with_ctes("players")
    + """SELECT app_id, current_players, snapshot_at FROM players
         QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY snapshot_at DESC) = 1""",
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots(spark, sf_dir).select("app_id", "current_players", "snapshot_at")
    return latest_per_key(rows, ["app_id"], [("snapshot_at", "desc")])


_TOP_LINES_ORDER = [
    ("l_extendedprice", "desc"),
    ("l_linenumber", "asc"),
    ("l_partkey", "asc"),
    ("l_suppkey", "asc"),
    ("l_quantity", "asc"),
]


@register(
    "W4_top_k_per_group",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(rn AS INTEGER) AS rn
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS FIRST,
                    l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn <= 5""",
)
def top_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return top_k_per_group(lines, ["l_orderkey"], _TOP_LINES_ORDER, 5, "rn")


_TOP_TAGS_SQL = with_ctes("d_tags") + (
    """SELECT load_id, array_to_string(list_slice(list(tag ORDER BY votes DESC, tag), 1, 5), ', ') AS top_tags
       FROM d_tags GROUP BY load_id"""
)


@register("W4_G5_top_tags", _TOP_TAGS_SQL)
def top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explode, rank, keep five, join the names in rank order."""
    tags = explode_object(
        bronze(spark, sf_dir, "raw_details"), "raw_data", "bigint", "$.tags", ["load_id"], "tag", "votes"
    )
    order = [("votes", "desc"), ("tag", "asc")]
    top = top_k_per_group(tags, ["load_id"], order, 5)
    return top.groupBy("load_id").agg(concat_ordered("tag", order).alias("top_tags"))


@register("W4_G5_top_tags_in_row", _TOP_TAGS_SQL)
def top_tags_in_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same inside each row, without a shuffle."""
    tags = bronze(spark, sf_dir, "raw_details").select(
        "load_id", top_keys("raw_data", "$.tags", 5).alias("top_tags")
    )
    return tags.filter(F.col("top_tags") != "")


@register(
    "W5_rank_column",
    with_ctes("stg_achievements")
    + """SELECT app_id, snapshot_at, achievement_name, round(unlock_pct, 6) AS unlock_pct,
                CAST(row_number() OVER (PARTITION BY app_id, snapshot_at
                     ORDER BY unlock_pct ASC NULLS LAST, achievement_name) AS INTEGER) AS difficulty_rank
         FROM stg_achievements""",
)
def difficulty_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = achievements(spark, sf_dir).select("app_id", "snapshot_at", "achievement_name", "unlock_pct")
    order = [("unlock_pct", "asc"), ("achievement_name", "asc")]
    return publish(rank_by(rows, ["app_id", "snapshot_at"], order, "difficulty_rank"))


@register(
    "W5_rank_hot_keys",
    """SELECT event_id, event_type, value, CAST(row_number() OVER (PARTITION BY event_type
              ORDER BY value ASC NULLS LAST, event_id) AS INTEGER) AS value_rank FROM events""",
)
def rank_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank within event types: every key is hot and gets cut into slices."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    order = [("value", "asc"), ("event_id", "asc")]
    return rank_by(events, ["event_type"], order, "value_rank", rows_per_task=_FEW_ROWS)


_LAG_SQL = """SELECT user_id, day, n, lag(n) OVER (PARTITION BY user_id ORDER BY day) AS prev_n
              FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)"""


@register("W6_lag", _LAG_SQL)
def lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return lag_by(daily, ["user_id"], [("day", "asc")], "n", "prev_n")


@register(
    "W6_lag_hot_keys",
    """SELECT event_id, event_type, ts, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id)
              AS prev_value FROM events""",
)
def lag_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous value within event types: every key is hot and gets cut into slices."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    order = [("ts", "asc"), ("event_id", "asc")]
    return lag_by(events, ["event_type"], order, "value", "prev_value", rows_per_task=_FEW_ROWS)


@register(
    "W5_rank_text_descending",
    """SELECT c_custkey, c_mktsegment, CAST(row_number() OVER (PARTITION BY c_mktsegment
              ORDER BY c_name DESC NULLS FIRST, c_custkey) AS INTEGER) AS name_rank FROM customer""",
)
def rank_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank by descending text within a few hot segments."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    order = [("c_name", "desc"), ("c_custkey", "asc")]
    ranked = rank_by(customers, ["c_mktsegment"], order, "name_rank", rows_per_task=_FEW_ROWS)
    return ranked.drop("c_name")
