"""Silver intermediate: joined sources and player trends."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.functions.scalars import (
    band,
    band_below,
    coalesce_priority,
    count_true,
    parse_range,
    pct_change,
)
from gildstar.operators.aggregates import overall_max, rollup_by
from gildstar.operators.filters import load_stamp, require
from gildstar.operators.joins import lookup
from gildstar.operators.series import lag_by
from gildstar.operators.skew import ROWS_PER_TASK

# Price bounds (exclusive) and review score bounds (inclusive).
PRICE_BANDS = [(5, "budget"), (20, "mid"), (40, "premium")]
TOP_PRICE_BAND = "aaa"
REVIEW_BANDS = [
    (0.95, "Overwhelmingly Positive"),
    (0.85, "Very Positive"),
    (0.70, "Mostly Positive"),
    (0.40, "Mixed"),
    (0.20, "Mostly Negative"),
]
LOWEST_REVIEW_BAND = "Overwhelmingly Negative"


def int_games_enriched(
    details: DataFrame,
    store: DataFrame,
    snapshots: DataFrame,
    load_ts: datetime | str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per game of the details source, with store attributes where known.

    Only the time of a game's latest snapshot is used, so the latest row per key
    is a partially aggregated MAX, and the overall MAX (for games without a
    snapshot) is taken over those per-game maxima.
    """
    latest = rollup_by(snapshots, ["app_id"], seen_at=F.max("snapshot_at"))
    st = store.select("app_id", F.struct(*[c for c in store.columns if c != "app_id"]).alias("st"))
    spine = require(details, "app_id")
    joined = lookup(lookup(spine, st, ["app_id"], "left", rows_per_task), latest, ["app_id"], "left", rows_per_task)
    is_free = F.coalesce(F.col("st.is_free"), F.col("price_usd") == 0)
    platforms = {p: F.coalesce(F.col(f"st.{p}"), F.lit(False)) for p in
                 ("platform_windows", "platform_mac", "platform_linux")}
    owners_min, owners_max = parse_range("owners_range")
    merged = {
        "name": ["st.name", "name"],
        "developer": ["st.developer", "developer"],
        "publisher": ["st.publisher", "publisher"],
    }
    return joined.select(
        "app_id",
        *coalesce_priority(merged),
        "st.app_type",
        "st.short_description",
        "price_usd",
        "initial_price_usd",
        "st.price_eur",
        "st.initial_price_eur",
        *coalesce_priority({"discount_pct": ["st.discount_pct", "discount_pct"]}),
        is_free.alias("is_free"),
        band_below("price_usd", PRICE_BANDS, TOP_PRICE_BAND, override=(is_free, "free")).alias("price_tier"),
        "st.genres_raw",
        "st.categories_raw",
        F.col("genres").alias("genres_details"),
        "tags",
        *[expr.alias(name) for name, expr in platforms.items()],
        (count_true(*platforms.values()) >= 2).alias("is_multi_platform"),
        (count_true(*platforms.values()) >= 1).alias("has_any_platform"),
        "st.supported_languages_raw",
        "st.release_date_raw",
        "st.is_coming_soon",
        "owners_range",
        owners_min.alias("owners_min"),
        owners_max.alias("owners_max"),
        "positive_reviews",
        "negative_reviews",
        (F.col("positive_reviews") + F.col("negative_reviews")).alias("total_reviews"),
        "review_score",
        band("review_score", REVIEW_BANDS, LOWEST_REVIEW_BAND).alias("review_score_label"),
        "current_players",
        "avg_playtime_forever_min",
        "avg_playtime_2weeks_min",
        "median_playtime_forever_min",
        "median_playtime_2weeks_min",
        F.coalesce(F.col("seen_at"), overall_max(latest, "seen_at")).alias("snapshot_at"),
        "_ingested_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )


def trend_label(previous: str, pct: str):
    """Label of a change in players; NULL previous means the first snapshot."""
    return (
        F.when(F.col(previous).isNull(), "first_snapshot")
        .when(F.col(pct) >= 10, "growing")
        .when(F.col(pct) <= -10, "declining")
        .otherwise("stable")
    )


def int_player_trends(
    snapshots: DataFrame,
    details: DataFrame,
    load_ts: datetime | str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Change in players against the same game's previous snapshot.

    The window runs on narrow snapshot rows; game attributes join afterwards.
    """
    series = require(snapshots, "app_id").select("app_id", "current_players", "snapshot_at", "_ingested_at")
    order = [("snapshot_at", "asc"), ("_ingested_at", "asc")]
    lagged = lag_by(series, ["app_id"], order, "current_players", "previous_players", rows_per_task)
    attributes = details.select(
        "app_id",
        "name",
        "avg_playtime_forever_min",
        "avg_playtime_2weeks_min",
        "median_playtime_forever_min",
    )
    joined = lookup(lagged, attributes, ["app_id"], "left", rows_per_task)
    return (
        joined.withColumn("players_delta", F.col("current_players") - F.col("previous_players"))
        .withColumn("players_pct_change", pct_change("current_players", "previous_players"))
        .select(
            "app_id",
            "name",
            "current_players",
            "previous_players",
            "snapshot_at",
            "players_delta",
            "players_pct_change",
            trend_label("previous_players", "players_pct_change").alias("trend_label"),
            "avg_playtime_forever_min",
            "avg_playtime_2weeks_min",
            "median_playtime_forever_min",
            "_ingested_at",
            load_stamp(load_ts).alias("_loaded_at"),
        )
    )
