"""Silver staging: typed, deduplicated rows from raw payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.functions.scalars import band, cents_to_money, safe_ratio
from gildstar.functions.variant import array_has
from gildstar.operators.dedupe import latest_per_key
from gildstar.operators.extract import explode_array, extract
from gildstar.operators.filters import load_stamp, require

# Payload paths, types and output names.
DETAILS_FIELDS = {
    "app_id": ("$.appid", "bigint"),
    "name": ("$.name", "string"),
    "developer": ("$.developer", "string"),
    "publisher": ("$.publisher", "string"),
    "price_cents": ("$.price", "bigint"),
    "initial_price_cents": ("$.initialprice", "bigint"),
    "discount_pct": ("$.discount", "bigint"),
    "current_players": ("$.ccu", "bigint"),
    "avg_playtime_forever_min": ("$.average_forever", "bigint"),
    "avg_playtime_2weeks_min": ("$.average_2weeks", "bigint"),
    "median_playtime_forever_min": ("$.median_forever", "bigint"),
    "median_playtime_2weeks_min": ("$.median_2weeks", "bigint"),
    "positive_reviews": ("$.positive", "bigint"),
    "negative_reviews": ("$.negative", "bigint"),
    "owners_range": ("$.owners", "string"),
    "genres": ("$.genre", "string"),
    "languages": ("$.languages", "string"),
    "tags": ("$.tags", "variant"),
}
STORE_FIELDS = {
    "name": ("$.name", "string"),
    "app_type": ("$.type", "string"),
    "short_description": ("$.short_description", "string"),
    "developer": ("$.developers[0]", "string"),
    "publisher": ("$.publishers[0]", "string"),
    "currency": ("$.price_overview.currency", "string"),
    "final_cents": ("$.price_overview.final", "bigint"),
    "initial_cents": ("$.price_overview.initial", "bigint"),
    "discount_pct": ("$.price_overview.discount_percent", "bigint"),
    "is_free": ("$.is_free", "boolean"),
    "release_date_raw": ("$.release_date.date", "string"),
    "is_coming_soon": ("$.release_date.coming_soon", "boolean"),
    "genres_raw": ("$.genres", "variant"),
    "categories_raw": ("$.categories", "variant"),
    "platform_windows": ("$.platforms.windows", "boolean"),
    "platform_mac": ("$.platforms.mac", "boolean"),
    "platform_linux": ("$.platforms.linux", "boolean"),
    "supported_languages_raw": ("$.supported_languages", "string"),
    "website": ("$.website", "string"),
}
ACHIEVEMENT_FIELDS = {
    "achievement_name": ("$.name", "string"),
    "unlock_pct": ("$.percent", "double"),
}
# Unlock percentages at which an achievement stops being rarer.
DIFFICULTY_BANDS = [(50.0, "common"), (20.0, "uncommon"), (5.0, "rare")]
HARDEST = "ultra_rare"

_NEWEST = [("_ingested_at", "desc"), ("_load_id", "desc")]


def _envelope():
    return [F.col("ingested_at").alias("_ingested_at"), F.col("load_id").alias("_load_id")]


def stg_details_games(raw: DataFrame, load_ts: datetime | str, on_error: str = "fail") -> DataFrame:
    """One row per game from the details payloads, newest load wins."""
    fields = extract(raw, "raw_data", DETAILS_FIELDS, keep=_envelope(), on_error=on_error)
    latest = latest_per_key(fields, ["app_id"], _NEWEST)
    return latest.select(
        "app_id",
        "name",
        "developer",
        "publisher",
        cents_to_money("price_cents").alias("price_usd"),
        cents_to_money("initial_price_cents").alias("initial_price_usd"),
        "discount_pct",
        "current_players",
        "avg_playtime_forever_min",
        "avg_playtime_2weeks_min",
        "median_playtime_forever_min",
        "median_playtime_2weeks_min",
        "positive_reviews",
        "negative_reviews",
        safe_ratio(
            "positive_reviews", F.col("positive_reviews") + F.col("negative_reviews")
        ).alias("review_score"),
        "owners_range",
        "genres",
        "languages",
        "tags",
        "_ingested_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )


class MissingIdError(ValueError):
    """No payload of a raw table has an id at the path given for it."""


def require_ids(raw: DataFrame, id_path: str, table: str) -> None:
    """Raise if a raw table has rows but none with an id, as with a wrong path; stops at the first id."""
    if raw.filter(F.try_variant_get("raw_data", id_path, "bigint").isNotNull()).isEmpty() and not raw.isEmpty():
        raise MissingIdError(f"no payload of {table} has an id at {id_path}")


def stg_store_games(
    raw: DataFrame, load_ts: datetime | str, id_path: str = "$.appid", on_error: str = "fail"
) -> DataFrame:
    """One row per game from the store payloads, newest load wins.

    ``id_path`` is where the store payload keeps the game's id.
    """
    spec = {"app_id": (id_path, "bigint"), **STORE_FIELDS}
    fields = extract(raw, "raw_data", spec, keep=_envelope(), on_error=on_error)
    latest = latest_per_key(fields, ["app_id"], _NEWEST)
    return latest.select(
        "app_id",
        "name",
        "app_type",
        "short_description",
        "developer",
        "publisher",
        "currency",
        cents_to_money("final_cents").alias("price_eur"),
        cents_to_money("initial_cents").alias("initial_price_eur"),
        "discount_pct",
        "is_free",
        "release_date_raw",
        "is_coming_soon",
        array_has("genres_raw", "$", "description", "Early Access").alias("is_early_access"),
        "genres_raw",
        "categories_raw",
        "platform_windows",
        "platform_mac",
        "platform_linux",
        "supported_languages_raw",
        "website",
        "_ingested_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )


def stg_player_snapshots(raw: DataFrame, load_ts: datetime | str, on_error: str = "fail") -> DataFrame:
    """Player counts, one row per game and snapshot; repeats are kept."""
    spec = {"player_count_raw": ("$.players.player_count", "bigint")}
    keep = [
        F.col("appid").cast("bigint").alias("app_id"),
        F.col("player_count").cast("bigint").alias("current_players"),
        "snapshot_at",
        F.col("ingested_at").alias("_ingested_at"),
    ]
    fields = extract(raw, "raw_data", spec, keep=keep, on_error=on_error)
    return require(fields, "app_id", "snapshot_at").select(
        "app_id",
        "current_players",
        "snapshot_at",
        "player_count_raw",
        "_ingested_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )


def stg_player_achievements(raw: DataFrame, load_ts: datetime | str, on_error: str = "fail") -> DataFrame:
    """One row per game, snapshot and achievement."""
    keep = [
        F.col("appid").cast("bigint").alias("app_id"),
        "snapshot_at",
        F.col("ingested_at").alias("_ingested_at"),
    ]
    known = raw.filter(F.col("appid").isNotNull())
    rows = explode_array(
        known, "raw_data", "$.achievements.achievements", ACHIEVEMENT_FIELDS, keep, on_error
    )
    return require(rows, "achievement_name").select(
        "app_id",
        "achievement_name",
        "unlock_pct",
        band("unlock_pct", DIFFICULTY_BANDS, HARDEST).alias("difficulty_label"),
        "snapshot_at",
        "_ingested_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )
