"""Gold dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.keys import date_key, surrogate_key
from gildstar.functions.scalars import category, contains_text, csv_element
from gildstar.functions.variant import top_keys
from gildstar.operators.aggregates import any_true, distinct_members, rollup_by, rounded_avg
from gildstar.operators.dims import current_dim, date_spine, static_dim
from gildstar.operators.filters import require

# Price tier catalogue, calendar range, genre categories.
PRICE_TIERS = [
    (1, "free", 0.00, 0.00, 1),
    (2, "budget", 0.01, 4.99, 2),
    (3, "mid", 5.00, 19.99, 3),
    (4, "premium", 20.00, 39.99, 4),
    (5, "aaa", 40.00, None, 5),
]
PRICE_TIER_SCHEMA = (
    "price_tier_key int, tier_label string, min_price_usd double, max_price_usd double, display_order int"
)
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)
GENRE_CATEGORIES = {
    "monetization_model": ["Free To Play"],
    "release_state": ["Early Access"],
    "core_genre": [
        "Massively Multiplayer",
        "Racing",
        "Sports",
        "Simulation",
        "Strategy",
        "RPG",
        "Action",
        "Adventure",
        "Casual",
        "Indie",
    ],
}
OTHER_CATEGORY = "other"
TOP_TAGS = 5


def dim_price_tier(spark: SparkSession) -> DataFrame:
    """Five price segments."""
    return static_dim(spark, PRICE_TIERS, PRICE_TIER_SCHEMA)


def calendar_columns(day: str = "date_day") -> list[Column]:
    """Calendar attributes of a DATE; Sunday is day 1."""
    d = F.col(day)
    weekend = F.dayofweek(d).isin(1, 7)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("quarter_label"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.left(F.monthname(d), F.lit(3)).alias("month_short"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
    ]


def dim_date(
    spark: SparkSession,
    start: date | str | Column = CALENDAR_START,
    end: date | str | Column = CALENDAR_END,
    include_end: bool = True,
) -> DataFrame:
    """Calendar, one row per day."""
    return date_spine(spark, start, end, "date_day", include_end).select(*calendar_columns())


def dim_genre(games: DataFrame) -> DataFrame:
    """Distinct genres of the details source."""
    names = distinct_members(require(games, "genres_details"), "genres_details", "genre_name")
    return names.select(
        surrogate_key("genre_name").alias("genre_key"),
        "genre_name",
        category("genre_name", GENRE_CATEGORIES, OTHER_CATEGORY).alias("genre_category"),
    )


def dim_developer(games: DataFrame) -> DataFrame:
    """Developers with their roll-up."""
    rolled = rollup_by(
        require(games, "developer"),
        ["developer"],
        publisher_name=F.max("publisher"),
        is_indie=any_true(contains_text("genres_details", "Indie")),
        total_games=F.count(F.lit(1)),
        avg_review_score=rounded_avg("review_score", 3),
        total_current_players=F.sum("current_players"),
    )
    return rolled.select(
        surrogate_key("developer").alias("developer_key"),
        F.col("developer").alias("developer_name"),
        "publisher_name",
        "is_indie",
        "total_games",
        "avg_review_score",
        "total_current_players",
    )


def dim_games(games: DataFrame) -> DataFrame:
    """Current attributes of every game.

    ``games`` has one row per game, so genre text and top tags are computed in
    the row itself and the whole dimension is one narrow projection.
    """
    described = games.select(
        surrogate_key("app_id").alias("game_key"),
        "app_id",
        "name",
        "developer",
        "publisher",
        F.coalesce(csv_element("genres_details", 1), F.lit("Unknown")).alias("primary_genre"),
        F.coalesce(F.col("genres_details"), F.lit("Unknown")).alias("all_genres"),
        F.coalesce(top_keys("tags", "$", TOP_TAGS), F.lit("")).alias("top_tags"),
        "platform_windows",
        "platform_mac",
        "platform_linux",
        "is_multi_platform",
        "is_free",
        "is_coming_soon",
        "price_tier",
        "price_usd",
        "release_date_raw",
        "snapshot_at",
        "_loaded_at",
    )
    dim = current_dim(described, "snapshot_at")
    return dim.select(*[c for c in dim.columns if c != "_loaded_at"], "_loaded_at")
