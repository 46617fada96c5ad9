"""Gold facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.functions.keys import date_key, default_key, surrogate_key
from gildstar.functions.scalars import csv_element, midpoint
from gildstar.operators.dedupe import latest_per_key
from gildstar.operators.filters import load_stamp
from gildstar.operators.joins import Dim, lookup, star_join
from gildstar.operators.series import rank_by
from gildstar.operators.skew import ROWS_PER_TASK

_LATEST_GAME = [("_loaded_at", "desc"), ("_ingested_at", "desc")]


def _date_dim(dim_date: DataFrame) -> Dim:
    return Dim(dim_date, "date_key", "date_key", match=date_key("snapshot_at"))


def game_star(
    games: DataFrame, dims: dict[str, DataFrame], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Per game: the keys of its dimensions and the attributes facts copy.

    All dimensions but the calendar hang off the game, so they are looked up
    once per game and not once per snapshot.  Store the result before joining
    facts to it: Spark then knows its size, which it cannot estimate through a
    chain of joins, and broadcasts it only if it is small.
    """
    game = latest_per_key(games, ["app_id"], _LATEST_GAME).select(
        "app_id",
        "developer",
        "price_tier",
        "genres_details",
        "avg_playtime_2weeks_min",
        "median_playtime_forever_min",
        "owners_min",
        "owners_max",
        midpoint("owners_min", "owners_max").alias("owners_midpoint"),
        "positive_reviews",
        "negative_reviews",
        "total_reviews",
        "review_score",
        "review_score_label",
        "price_usd",
        "discount_pct",
        (F.col("discount_pct") > 0).alias("is_on_sale"),
    )
    unknown = default_key("Unknown")
    keyed = star_join(
        game,
        [
            Dim(dims["dim_games"], "app_id", "game_key", F.col("app_id"), where=F.col("is_current")),
            Dim(dims["dim_genre"], "genre_name", "genre_key", csv_element("genres_details", 1), unknown),
            Dim(dims["dim_developer"], "developer_name", "developer_key", F.col("developer"), unknown),
            Dim(dims["dim_price_tier"], "tier_label", "price_tier_key", F.col("price_tier"), F.lit(1)),
        ],
        rows_per_task,
    )
    return keyed.drop("developer", "price_tier", "genres_details")


def fct_game_snapshots(
    snapshots: DataFrame,
    star: DataFrame,
    dim_date: DataFrame,
    load_ts: datetime | str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Snapshot metrics per game; ``star`` is the stored ``game_star``.

    The large snapshot table joins once per game attribute set and once per day.
    """
    series = snapshots.select("app_id", "current_players", "snapshot_at")
    joined = lookup(series, star, ["app_id"], "inner", rows_per_task)
    return star_join(joined, [_date_dim(dim_date)]).select(
        surrogate_key("app_id", "snapshot_at").alias("snapshot_key"),
        "game_key",
        "date_key",
        "genre_key",
        "developer_key",
        "price_tier_key",
        "current_players",
        "avg_playtime_2weeks_min",
        "median_playtime_forever_min",
        "owners_min",
        "owners_max",
        "owners_midpoint",
        "positive_reviews",
        "negative_reviews",
        "total_reviews",
        "review_score",
        "review_score_label",
        "price_usd",
        "discount_pct",
        "is_on_sale",
        "snapshot_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )


def fct_achievement_stats(
    achievements: DataFrame,
    star: DataFrame,
    dim_date: DataFrame,
    load_ts: datetime | str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Achievement difficulty per game and snapshot; ``star`` is the stored ``game_star``.

    The rank is taken before the join: its groups are finer than the join key,
    so the join drops whole groups only, and ranking on (game, snapshot)
    spreads a game with a long history over many tasks.
    """
    rows = achievements.select(
        "app_id", "achievement_name", "unlock_pct", "difficulty_label", "snapshot_at"
    )
    ranked = rank_by(
        rows,
        ["app_id", "snapshot_at"],
        [("unlock_pct", "asc"), ("achievement_name", "asc")],
        "difficulty_rank",
        rows_per_task,
    )
    joined = lookup(ranked, star.select("app_id", "game_key"), ["app_id"], "inner", rows_per_task)
    return star_join(joined, [_date_dim(dim_date)]).select(
        surrogate_key("app_id", "achievement_name", "snapshot_at").alias("stat_key"),
        "game_key",
        "date_key",
        "achievement_name",
        "unlock_pct",
        "difficulty_label",
        "difficulty_rank",
        "snapshot_at",
        load_stamp(load_ts).alias("_loaded_at"),
    )
