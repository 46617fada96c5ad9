"""Scans, views, generated tables and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.operators.filters import null_of, with_load_ts
from gildstar.functions.scalars import band_below
from gildstar.operators.dims import date_spine, static_dim
from gildstar.operators.extract import extract
from gildstar.plans.dimensions import PRICE_TIER_SCHEMA, PRICE_TIERS
from gildstar.plans.intermediate import PRICE_BANDS, TOP_PRICE_BAND
from gildstar.queries.dataflows import details, snapshots
from gildstar.queries.registry import bronze, publish, register, table
from gildstar.queries.sqltext import PRICES_IN_CENTS, with_ctes
from gildstar.session import run_folder
from gildstar.sources import derived
from gildstar.sources.bronze import ENVELOPES, land_bronze, read_bronze
from gildstar.sources.landing import land_checked, read_rejects
from gildstar.sources.tables import register_views, write_table


@register(
    "A1_bronze_scan",
    with_ctes("players")
    + """SELECT load_id, 'web_api' AS source, app_id AS appid, snapshot_at,
                current_players AS player_count, player_count_raw AS payload_count FROM players""",
)
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land text payloads as VARIANT by day, then read the raw table back."""
    path = f"{run_folder(spark, 'scan')}/raw_players"
    land_bronze(derived.raw_players(spark, sf_dir), path, day_of="snapshot_at")
    return extract(
        read_bronze(spark, path),
        "raw_data",
        {"payload_count": ("$.players.player_count", "bigint")},
        keep=["load_id", "source", "appid", "snapshot_at", "player_count"],
    )


@register(
    "A1_bronze_scan_text",
    with_ctes("d_rows")
    + """SELECT load_id, 'details_api' AS source, 'appdetails' AS endpoint, k AS appid, app_id AS payload_appid,
                name FROM d_rows""",
)
def bronze_scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scan over JSON lines whose payload is still text."""
    path = f"{run_folder(spark, 'text')}/raw_details"
    derived.raw_details(spark, sf_dir).write.json(path)
    schema = "load_id string, source string, endpoint string, appid bigint, raw_data string"
    return extract(
        read_bronze(spark, path, fmt="json", schema=schema),
        "raw_data",
        {"payload_appid": ("$.appid", "bigint"), "name": ("$.name", "string")},
        keep=["load_id", "source", "endpoint", "appid"],
    )


@register(
    "A2_A5_views",
    with_ctes("players", "stg_details")
    + """SELECT d.app_id, d.name, count(s.snapshot_at) AS n_snapshots, max(s.current_players) AS peak_players
         FROM stg_details d LEFT JOIN players s ON s.app_id = d.app_id GROUP BY d.app_id, d.name""",
)
def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models as temporary views, combined in SQL."""
    register_views(
        {"gs_details": details(spark, sf_dir), "gs_snapshots": snapshots(spark, sf_dir)}
    )
    return spark.sql(
        """SELECT d.app_id, d.name, coalesce(s.n, 0) AS n_snapshots, s.peak AS peak_players
           FROM gs_details d
           LEFT JOIN (SELECT app_id, count(*) AS n, max(current_players) AS peak
                      FROM gs_snapshots GROUP BY app_id) s
             ON s.app_id = d.app_id"""
    )


@register(
    "A3_static_dim",
    with_ctes("stg_details", "dim_price_tier")
    + """SELECT t.tier_label, t.min_price_usd, t.max_price_usd, count(d.app_id) AS n_games
         FROM dim_price_tier t
         LEFT JOIN (SELECT app_id, """
    + PRICES_IN_CENTS.format(value="cents")
    + """ AS tier FROM stg_details) d
                ON d.tier = t.tier_label
         GROUP BY ALL""",
)
def static_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inline catalogue joined to what it classifies."""
    tier = band_below("price_usd", PRICE_BANDS, TOP_PRICE_BAND).alias("tier_label")
    used = details(spark, sf_dir).groupBy(tier).agg(F.count(F.lit(1)).alias("n_games"))
    tiers = static_dim(spark, PRICE_TIERS, PRICE_TIER_SCHEMA)
    return (
        tiers.join(used, "tier_label", "left")
        .fillna(0, ["n_games"])
        .select("tier_label", "min_price_usd", "max_price_usd", "n_games")
    )


@register(
    "A4_date_spine",
    """SELECT day, count(l_orderkey) AS n_lines
       FROM (SELECT CAST(unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day
             FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem))
       LEFT JOIN lineitem ON CAST(l_shipdate AS DATE) = day GROUP BY day""",
)
def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day per row, end excluded, over the days that lines ship on."""
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem").select(day.alias("day"))
    bounds = lines.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = date_spine(
        spark, bounds.select("lo").scalar(), bounds.select("hi").scalar(), "day", include_end=False
    )
    per_day = lines.groupBy("day").agg(F.count(F.lit(1)).alias("n_lines"))
    return days.join(per_day, "day", "left").fillna(0, ["n_lines"])


@register(
    "A6_O1_table_sink",
    """SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""",
)
def table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full rebuild of a partitioned table whose files are sorted by customer."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    path = f"{run_folder(spark, 'sink')}/orders"
    return write_table(orders, path, layout=[("o_custkey", "asc")], partition_by=["order_year"])


@register(
    "A1_quarantine",
    with_ctes("d_rows")
    + """SELECT load_id, CASE k % 50 WHEN 7 THEN 'malformed JSON' WHEN 8 THEN 'empty text' END AS reason,
                CASE WHEN k % 50 NOT IN (7, 8) THEN name END AS name FROM d_rows""",
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingestions with broken and empty payloads, each landed twice: bad rows are set aside with a reason."""
    raw = derived.raw_details(spark, sf_dir)
    text = (
        F.when(F.col("appid") % 50 == 7, F.expr("left(raw_data, length(raw_data) - 1)"))
        .when(F.col("appid") % 50 == 8, F.lit(" "))
        .otherwise(F.col("raw_data"))
    )
    broken = raw.withColumn("raw_data", text)
    folder = run_folder(spark, "quarantine")
    for number in (0, 1, 0):
        part = broken.filter(F.col("appid") % 2 == number)
        land_checked(part, f"{folder}/raw", f"{folder}/rejects", f"ingestion-{number}")
    envelope = ", ".join(c for c in ENVELOPES["raw_details"].split(", ") if not c.startswith("raw_data"))
    good = read_bronze(spark, f"{folder}/raw").select(
        "load_id", F.lit(None).cast("string").alias("reason"), F.expr("raw_data:name::string").alias("name")
    )
    bad = read_rejects(spark, f"{folder}/rejects", envelope)
    return good.unionByName(
        bad.select("load_id", F.col("_reason").alias("reason"), F.lit(None).cast("string").alias("name"))
    )


@register(
    "P13_audit_columns",
    with_ctes("s_rows")
    + """SELECT load_id, _ingested_at, TIMESTAMP '2024-03-01 00:00:00' AS _loaded_at,
                CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM s_rows""",
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carried ingestion time, stamped load time, typed NULL and boolean literals."""
    raw = bronze(spark, sf_dir, "raw_store").select(
        "load_id",
        F.col("ingested_at").alias("_ingested_at"),
        null_of("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return publish(with_load_ts(raw, "2024-03-01 00:00:00"))
