"""Incremental loads and history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.keys import date_key, surrogate_key
from gildstar.operators.asof import as_of_join
from gildstar.operators.dims import current_dim
from gildstar.operators.incremental import (
    Target,
    load_batch,
    load_full,
    load_incremental,
    merge_upsert,
    newer_than,
    read_target,
    sync_schema,
)
from gildstar.operators.scd2 import CLOSED_DAY, history_target, load_scd2, scd2_apply, scd2_start
from gildstar.plans import dimensions, facts, staging
from gildstar.plans.build import SNAPSHOT_DAY, fact_targets
from gildstar.queries.dataflows import snapshots, stored_star
from gildstar.queries.registry import LOAD_TS, bronze, publish, register, table
from gildstar.queries.sqltext import with_ctes
from gildstar.session import run_folder
from gildstar.sources.tables import write_table

# The moment at which the first of two ingestions ended.
CUT = datetime(2024, 1, 16, 12, 0, 0)


def _first_ingestion(raw: DataFrame) -> DataFrame:
    cut = F.lit(str(CUT)).cast("timestamp_ntz")
    return raw.filter(F.col("snapshot_at") <= cut)


@register(
    "L1_L4_load_snapshots",
    with_ctes("fct_snapshots")
    + "SELECT * REPLACE (round(review_score, 6) AS review_score) FROM fct_snapshots",
)
def load_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingestions, three loads: full, incremental, and one that finds nothing new."""
    star, dim_date = stored_star(spark, sf_dir), dimensions.dim_date(spark)
    everything = bronze(spark, sf_dir, "raw_players")
    target = fact_targets(run_folder(spark, "load"))["fct_game_snapshots"]

    def load(raw: DataFrame) -> DataFrame:
        def build(high: datetime | None) -> DataFrame:
            recent = newer_than(raw, high, "snapshot_at", SNAPSHOT_DAY)
            rows = staging.stg_player_snapshots(recent, LOAD_TS)
            return facts.fct_game_snapshots(rows, star, dim_date, LOAD_TS)

        return load_incremental(spark, build, target)

    load(_first_ingestion(everything))
    load(everything)
    return publish(load(everything))


@register(
    "L1_L4_load_achievements",
    with_ctes("fct_achievements")
    + "SELECT * REPLACE (round(unlock_pct, 6) AS unlock_pct) FROM fct_achievements",
)
def load_achievements(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, dim_date = stored_star(spark, sf_dir), dimensions.dim_date(spark)
    everything = bronze(spark, sf_dir, "raw_players")
    target = fact_targets(run_folder(spark, "load"))["fct_achievement_stats"]

    def load(raw: DataFrame) -> DataFrame:
        def build(high: datetime | None) -> DataFrame:
            recent = newer_than(raw, high, "snapshot_at", SNAPSHOT_DAY)
            rows = staging.stg_player_achievements(recent, LOAD_TS)
            return facts.fct_achievement_stats(rows, star, dim_date, LOAD_TS)

        return load_incremental(spark, build, target)

    load(_first_ingestion(everything))
    return publish(load(everything))


@register(
    "L2_newer_than",
    f"""SELECT event_id, ts, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_key FROM events
        WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{CUT}')""",
)
def newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows above the high-water mark of what was loaded before."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", date_key("ts").alias("day_key"))
    stored = write_table(events, f"{run_folder(spark, 'newer')}/events", partition_by=["day_key"])
    loaded = stored.filter(F.col("ts") <= F.lit(str(CUT)).cast("timestamp_ntz"))
    high = loaded.agg(F.max("ts")).collect()[0][0]
    return newer_than(stored, high, "ts", "day_key")


@register(
    "L3_merge_upsert",
    """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
       UNION ALL SELECT c_custkey, c_name || ' (new)', c_acctbal + 1 FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
       UNION ALL SELECT -c_custkey - 1, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY'""",
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment's customers change, another's have new keys."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    target = customer.drop("c_mktsegment")
    changed = customer.filter("c_mktsegment = 'HOUSEHOLD'").select(
        "c_custkey", F.concat("c_name", F.lit(" (new)")).alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal")
    )
    added = customer.filter("c_mktsegment = 'MACHINERY'").select(
        (-F.col("c_custkey") - 1).alias("c_custkey"), "c_name", "c_acctbal"
    )
    return merge_upsert(target, changed.unionByName(added), ["c_custkey"])


@register(
    "L4_schema_sync",
    """SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS s_tier, CAST(NULL AS DOUBLE) AS s_score FROM supplier""",
)
def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target loses columns the batch lacks and gains the batch's new ones."""
    supplier = table(spark, sf_dir, "supplier")
    batch = supplier.select(
        "s_suppkey",
        "s_name",
        F.lit("gold").alias("s_tier"),
        (F.col("s_acctbal") / 1000).alias("s_score"),
    )
    return sync_schema(supplier, batch.schema)


_TYPE_CHANGE_COLUMNS = """o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_clerk_number AS BIGINT) AS clerk,
              CAST(o_totalprice AS DECIMAL(18, 2)) AS total, o_orderdate AS ordered_at,
              CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key"""


@register(
    "L4_type_change",
    f"""SELECT * REPLACE (CAST(total AS DOUBLE) AS total)
        FROM (SELECT {_TYPE_CHANGE_COLUMNS}
              FROM (SELECT *, (o_orderkey * 7) % 1000 AS o_clerk_number FROM orders))""",
)
def type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded in two halves; the second has other types for three columns, so the days of the first are converted."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer"),
        ((F.col("o_orderkey") * 7) % 1000).alias("clerk"),
        F.col("o_totalprice").cast("double").alias("total"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered_at"),
    )
    dated = orders.withColumn("date_key", date_key("ordered_at"))
    target = Target(f"{run_folder(spark, 'load')}/orders", ["o_orderkey"], "ordered_at")
    before = dated.filter("o_orderkey % 2 = 0").withColumn("clerk", F.col("clerk").cast("string"))
    after = dated.filter("o_orderkey % 2 = 1").withColumns(
        {"customer": F.col("customer").cast("string"), "clerk": F.col("clerk").cast("long"), "total": F.col("total").cast("decimal(18,2)")}
    )
    load_full(spark, before, target)
    return publish(load_batch(spark, after, target))


@register(
    "L5_current_dim",
    """SELECT md5(CAST(o_custkey AS VARCHAR)) AS customer_key, o_custkey, max(o_orderdate) AS valid_from,
              CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM orders GROUP BY o_custkey""",
)
def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("seen_at"))
    keyed = seen.select(surrogate_key("o_custkey").alias("customer_key"), "o_custkey", "seen_at")
    return current_dim(keyed, "seen_at")


_HISTORY_SQL = with_ctes("d_rows") + (
    """SELECT md5(app_id || '-' || CAST(valid_from AS VARCHAR)) AS version_key, app_id, cents, discount_pct, valid_from,
                lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
         FROM (SELECT k AS app_id, cents, discount_pct,
                      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(v AS INTEGER)) AS valid_from
               FROM (SELECT *, lag(cents) OVER (PARTITION BY k ORDER BY v) AS before FROM d_rows)
               WHERE v = 0 OR cents IS DISTINCT FROM before)
         WINDOW w AS (PARTITION BY app_id ORDER BY valid_from)"""
)


def _daily_snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three daily snapshots of game prices; later ones lack some games."""
    loads = bronze(spark, sf_dir, "raw_details").select(
        F.col("appid").alias("app_id"),
        F.expr("raw_data:price::bigint").alias("cents"),
        F.expr("raw_data:discount::bigint").alias("discount_pct"),
        F.split_part("load_id", F.lit("-"), F.lit(3)).cast("int").alias("day"),
    )
    seen = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(day)")

    return [loads.withColumn("seen_at", seen).filter(F.col("day") == d).drop("day") for d in range(3)]


@register("L6_scd2", _HISTORY_SQL)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price history, rebuilt with each snapshot; games missing from one stay open."""
    folder = run_folder(spark, "history")
    first, *later = _daily_snapshots(spark, sf_dir)
    opened = scd2_start(first, ["app_id"], "seen_at")
    out = write_table(opened, f"{folder}/day0", partition_by=["is_current"])
    for day, snapshot in enumerate(later, 1):
        changed = scd2_apply(out, snapshot, ["app_id"], ["cents", "discount_pct"], "seen_at")
        out = write_table(changed, f"{folder}/day{day}", partition_by=["is_current"])
    return out


@register("L6_scd2_stored", _HISTORY_SQL)
def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stored history that rewrites only what a snapshot changes."""
    target = history_target(f"{run_folder(spark, 'history')}/prices")
    for snapshot in _daily_snapshots(spark, sf_dir):
        load_scd2(spark, snapshot, target, ["app_id"], ["cents", "discount_pct"], "seen_at")
    return read_target(spark, target).drop(CLOSED_DAY)


@register(
    "L6_as_of_facts",
    with_ctes("d_rows", "players")
    + f"""SELECT p.app_id, p.snapshot_at, p.current_players, h.version_key, h.cents, h.discount_pct
          FROM players p LEFT JOIN ({_HISTORY_SQL[_HISTORY_SQL.index("SELECT md5") :]}) h
            ON h.app_id = p.app_id AND p.snapshot_at >= h.valid_from
               AND (h.valid_to IS NULL OR p.snapshot_at < h.valid_to)""",
)
def as_of_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every player snapshot with the price that was valid then."""
    target = history_target(f"{run_folder(spark, 'history')}/prices")
    for snapshot in _daily_snapshots(spark, sf_dir):
        load_scd2(spark, snapshot, target, ["app_id"], ["cents", "discount_pct"], "seen_at")
    rows = snapshots(spark, sf_dir).select("app_id", "snapshot_at", "current_players")
    return as_of_join(
        rows, read_target(spark, target), ["app_id"], "snapshot_at", ["version_key", "cents", "discount_pct"]
    )
