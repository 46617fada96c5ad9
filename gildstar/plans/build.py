"""The whole build: bronze tables in, silver and gold tables out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from gildstar.operators.incremental import Target, load_incremental, newer_than
from gildstar.operators.skew import ROWS_PER_TASK
from gildstar.plans import dimensions, facts, intermediate, staging
from gildstar.session import whole_variants
from gildstar.sources.tables import write_table

SNAPSHOT_DAY = "snapshot_at_day"


def stage_all(bronze: Mapping[str, DataFrame], load_ts: datetime | str, store_id_path: str = "$.appid") -> dict[str, DataFrame]:
    """The four staging views."""
    return {
        "stg_details_games": staging.stg_details_games(bronze["raw_details"], load_ts),
        "stg_store_games": staging.stg_store_games(bronze["raw_store"], load_ts, store_id_path),
        "stg_player_snapshots": staging.stg_player_snapshots(bronze["raw_players"], load_ts),
        "stg_player_achievements": staging.stg_player_achievements(bronze["raw_players"], load_ts),
    }


def fact_targets(out_dir: str) -> dict[str, Target]:
    """Facts keep files by the snapshot's own day; their keys hold its time, so newer rows are always new."""
    keys = {"fct_game_snapshots": "snapshot_key", "fct_achievement_stats": "stat_key"}
    return {
        name: Target(f"{out_dir}/{name}", [key], "snapshot_at", "snapshot_day", appends=True, day_of="snapshot_at")
        for name, key in keys.items()
    }


def build(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    out_dir: str,
    load_ts: datetime | str,
    store_id_path: str = "$.appid",
    full_refresh: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[str, DataFrame]:
    """Run the build and return every model by name.

    Staging and trends stay views.  The enriched games, which five models read,
    are stored once and read back, as are the dimensions.  Facts load
    incrementally: a second call with more bronze rows adds only newer
    snapshots.  ``bronze`` should be stored with its payload as VARIANT (see
    ``land_bronze``); its players table may carry a ``snapshot_at_day`` column.
    A store table none of whose payloads has its id at ``store_id_path`` raises
    ``MissingIdError``.
    """
    staging.require_ids(bronze["raw_store"], store_id_path, "raw_store")
    models = stage_all(bronze, load_ts, store_id_path)
    enriched = intermediate.int_games_enriched(
        models["stg_details_games"],
        models["stg_store_games"],
        models["stg_player_snapshots"],
        load_ts,
        rows_per_task,
    )
    with whole_variants(spark):
        models["int_games_enriched"] = write_table(enriched, f"{out_dir}/int_games_enriched")
    games = models["int_games_enriched"]
    models["int_player_trends"] = intermediate.int_player_trends(
        models["stg_player_snapshots"], models["stg_details_games"], load_ts, rows_per_task
    )
    rebuilt = {
        "dim_date": (dimensions.dim_date(spark), []),
        "dim_price_tier": (dimensions.dim_price_tier(spark), []),
        "dim_genre": (dimensions.dim_genre(games), [("genre_category", "asc"), ("genre_name", "asc")]),
        "dim_developer": (dimensions.dim_developer(games), [("total_current_players", "desc")]),
        "dim_games": (dimensions.dim_games(games), []),
    }
    models.update(
        _side_by_side(
            spark,
            {n: partial(write_table, df, f"{out_dir}/{n}", layout) for n, (df, layout) in rebuilt.items()},
        )
    )

    star = write_table(facts.game_star(games, models, rows_per_task), f"{out_dir}/game_star")
    raw = bronze["raw_players"]
    day = SNAPSHOT_DAY if SNAPSHOT_DAY in raw.columns else None

    def snapshots(high: datetime | None) -> DataFrame:
        recent = staging.stg_player_snapshots(newer_than(raw, high, "snapshot_at", day), load_ts)
        return facts.fct_game_snapshots(recent, star, models["dim_date"], load_ts, rows_per_task)

    def achievements(high: datetime | None) -> DataFrame:
        recent = staging.stg_player_achievements(newer_than(raw, high, "snapshot_at", day), load_ts)
        return facts.fct_achievement_stats(recent, star, models["dim_date"], load_ts, rows_per_task)

    targets = fact_targets(out_dir)
    loads = {"fct_game_snapshots": snapshots, "fct_achievement_stats": achievements}
    models.update(
        _side_by_side(
            spark,
            {n: partial(load_incremental, spark, fn, targets[n], full_refresh) for n, fn in loads.items()},
        )
    )
    return models


def _side_by_side(
    spark: SparkSession, writes: dict[str, Callable[[], DataFrame]]
) -> dict[str, DataFrame]:
    """Submit independent writes together, so that one's last tasks overlap the next's."""
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(fn)) for name, fn in writes.items()}
        return {name: future.result() for name, future in running.items()}
