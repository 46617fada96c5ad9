"""The thirteen dataflows on bronze derived from ``part`` and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.scalars import pct_change
from gildstar.operators.series import lag_by
from gildstar.plans import dimensions, facts, intermediate, staging
from gildstar.queries.registry import LOAD_TS, bronze, publish, register, table
from gildstar.queries.sqltext import TREND, calendar_sql, with_ctes
from gildstar.session import run_folder, whole_variants
from gildstar.sources.tables import write_table

_LOADED = f"TIMESTAMP '{LOAD_TS}' AS _loaded_at"


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_details_games(bronze(spark, sf_dir, "raw_details"), LOAD_TS)


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_store_games(bronze(spark, sf_dir, "raw_store"), LOAD_TS)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_player_snapshots(bronze(spark, sf_dir, "raw_players"), LOAD_TS)


def achievements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_player_achievements(bronze(spark, sf_dir, "raw_players"), LOAD_TS)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_games_enriched(
        details(spark, sf_dir), store(spark, sf_dir), snapshots(spark, sf_dir), LOAD_TS
    )


def stored_games(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Enriched games written once, for queries that read them several times; all columns or those named."""
    enriched = games(spark, sf_dir)
    wanted = enriched.select(*columns) if columns else enriched
    with whole_variants(spark):
        return write_table(wanted, f"{run_folder(spark, 'games')}/int_games_enriched")


def stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched games and the keys of their dimensions, each written once."""
    folder = run_folder(spark, "star")
    found = games(spark, sf_dir)  # lands raw tables, which have a layout of their own
    with whole_variants(spark):
        enriched = write_table(found, f"{folder}/int_games_enriched")
    dims = {
        "dim_games": dimensions.dim_games(enriched),
        "dim_genre": dimensions.dim_genre(enriched),
        "dim_developer": dimensions.dim_developer(enriched),
        "dim_price_tier": dimensions.dim_price_tier(spark),
    }
    return write_table(facts.game_star(enriched, dims), f"{folder}/game_star")


@register(
    "stg_details_games",
    with_ctes("stg_details")
    + f"""SELECT app_id, name, developer, publisher, price_usd, initial_price_usd, discount_pct, current_players,
                 avg_playtime_forever_min, avg_playtime_2weeks_min, median_playtime_forever_min,
                 median_playtime_2weeks_min, positive_reviews, negative_reviews,
                 round(review_score, 6) AS review_score, owners_range, genres, languages, _ingested_at, {_LOADED}
          FROM stg_details""",
)
def stg_details_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(details(spark, sf_dir))


@register(
    "stg_store_games",
    with_ctes("stg_store")
    + f"""SELECT app_id, name, app_type, short_description, developer, publisher, currency, price_eur,
                 initial_price_eur, discount_pct, is_free, release_date_raw, is_coming_soon, is_early_access,
                 platform_windows, platform_mac, platform_linux, supported_languages_raw, website, _ingested_at,
                 {_LOADED}
          FROM stg_store""",
)
def stg_store_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(store(spark, sf_dir))


@register(
    "stg_player_snapshots",
    with_ctes("players")
    + f"SELECT app_id, current_players, snapshot_at, player_count_raw, _ingested_at, {_LOADED} FROM players",
)
def stg_player_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(snapshots(spark, sf_dir))


@register(
    "stg_player_achievements",
    with_ctes("stg_achievements")
    + f"""SELECT app_id, achievement_name, round(unlock_pct, 6) AS unlock_pct, difficulty_label, snapshot_at,
                 _ingested_at, {_LOADED} FROM stg_achievements""",
)
def stg_player_achievements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(achievements(spark, sf_dir))


@register(
    "int_games_enriched",
    with_ctes("games")
    + "SELECT * EXCLUDE (_load_id) REPLACE (round(review_score, 6) AS review_score) FROM games",
)
def int_games_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(games(spark, sf_dir))


@register(
    "int_player_trends",
    with_ctes("trends")
    + "SELECT * REPLACE (round(players_pct_change, 6) AS players_pct_change) FROM trends",
)
def int_player_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(
        intermediate.int_player_trends(snapshots(spark, sf_dir), details(spark, sf_dir), LOAD_TS)
    )


@register(
    "dim_date",
    f"""SELECT {calendar_sql('date_day')}, n_orders
        FROM (SELECT date_day, count(o_orderkey) AS n_orders
              FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
                    FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))
              LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_day GROUP BY date_day)""",
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the days orders cover, with the orders of each day."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    bounds = orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    calendar = dimensions.dim_date(
        spark, bounds.select("lo").scalar(), bounds.select("hi").scalar()
    )
    per_day = orders.groupBy(day.alias("full_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return calendar.join(per_day, "full_date", "left").fillna(0, ["n_orders"])


@register(
    "dim_price_tier",
    with_ctes("games", "dim_price_tier")
    + """SELECT t.*, count(g.app_id) AS n_games
         FROM dim_price_tier t LEFT JOIN games g ON g.price_tier = t.tier_label GROUP BY ALL""",
)
def dim_price_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tier catalogue with the number of games in each tier."""
    per_tier = (
        games(spark, sf_dir)
        .groupBy(F.col("price_tier").alias("tier_label"))
        .agg(F.count(F.lit(1)).alias("n_games"))
    )
    tiers = dimensions.dim_price_tier(spark)
    return tiers.join(per_tier, "tier_label", "left").fillna(0, ["n_games"])


@register("dim_genre", with_ctes("dim_genre") + "SELECT * FROM dim_genre")
def dim_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_genre(games(spark, sf_dir))


@register("dim_developer", with_ctes("dim_developer") + "SELECT * FROM dim_developer")
def dim_developer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(dimensions.dim_developer(games(spark, sf_dir)))


@register("dim_games", with_ctes("dim_games") + "SELECT * FROM dim_games")
def dim_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(dimensions.dim_games(games(spark, sf_dir)))


@register(
    "fct_game_snapshots",
    with_ctes("fct_snapshots")
    + "SELECT * REPLACE (round(review_score, 6) AS review_score) FROM fct_snapshots",
)
def fct_game_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, dim_date = stored_star(spark, sf_dir), dimensions.dim_date(spark)
    return publish(facts.fct_game_snapshots(snapshots(spark, sf_dir), star, dim_date, LOAD_TS))


@register(
    "fct_achievement_stats",
    with_ctes("fct_achievements")
    + "SELECT * REPLACE (round(unlock_pct, 6) AS unlock_pct) FROM fct_achievements",
)
def fct_achievement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, dim_date = stored_star(spark, sf_dir), dimensions.dim_date(spark)
    return publish(
        facts.fct_achievement_stats(achievements(spark, sf_dir), star, dim_date, LOAD_TS)
    )


@register(
    "daily_trend",
    f"""SELECT user_id, day, n, prev_n, round(pct, 6) AS pct, {TREND.format(prev='prev_n', pct='pct')} AS trend_label
       FROM (SELECT *, (n - prev_n) / CAST(prev_n AS DOUBLE) * 100.0 AS pct
             FROM (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY day) AS prev_n
                   FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)))""",
)
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend of daily events per user: the trend dataflow on a native table."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lagged = lag_by(daily, ["user_id"], [("day", "asc")], "n", "prev_n")
    return publish(
        lagged.withColumn("pct", pct_change("n", "prev_n")).withColumn(
            "trend_label", intermediate.trend_label("prev_n", "pct")
        )
    )
