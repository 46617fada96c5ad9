"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from test_dataflows import NOW, T, ach, details_doc, raw_details, raw_players, raw_store, store_doc

from gildstar.operators.dedupe import latest_per_key, top_k_per_group
from gildstar.operators.incremental import newer_than
from gildstar.plans import dimensions, facts, intermediate, staging
from gildstar.sources.bronze import land_bronze
from gildstar.sources.tables import write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|round|Single)", plan(df)))


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    return {
        "details": land_bronze(raw_details(spark, *[("a", T[0], details_doc(i)) for i in range(1, 9)]), f"{root}/d"),
        "store": land_bronze(raw_store(spark, *[("a", T[0], store_doc(i)) for i in range(1, 5)]), f"{root}/s"),
        "players": land_bronze(
            raw_players(spark, *[(i, T[d], 5, ach(("a", 1.0))) for i in range(1, 9) for d in range(4)]),
            f"{root}/p",
            day_of="snapshot_at",
        ),
    }


@pytest.fixture(scope="module")
def enriched(bronze, tmp_path_factory):
    df = intermediate.int_games_enriched(
        staging.stg_details_games(bronze["details"], NOW),
        staging.stg_store_games(bronze["store"], NOW),
        staging.stg_player_snapshots(bronze["players"], NOW),
        NOW,
    )
    return write_table(df, str(tmp_path_factory.mktemp("silver") / "games"))


@pytest.fixture(scope="module")
def star(spark, enriched, tmp_path_factory):
    dims = {
        "dim_games": dimensions.dim_games(enriched),
        "dim_genre": dimensions.dim_genre(enriched),
        "dim_developer": dimensions.dim_developer(enriched),
        "dim_price_tier": dimensions.dim_price_tier(spark),
    }
    return write_table(facts.game_star(enriched, dims), str(tmp_path_factory.mktemp("gold") / "star"))


def test_dedupe_limits_groups_before_its_one_shuffle(bronze):
    df = staging.stg_details_games(bronze["details"], NOW)
    text = plan(df)
    assert shuffles(df) == 1
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


@pytest.mark.parametrize("k", [1, 5])
def test_top_k_is_a_group_limit(bronze, k):
    rows = bronze["players"].select("appid", "snapshot_at")
    text = plan(top_k_per_group(rows, ["appid"], [("snapshot_at", "desc")], k))
    assert text.count("WindowGroupLimit") == 2


def test_null_keys_are_filtered_in_the_scan(bronze):
    text = plan(latest_per_key(bronze["players"], ["appid"], [("snapshot_at", "desc")]))
    assert "PushedFilters: [IsNotNull(appid)]" in text


def test_unused_columns_and_fields_are_not_read(bronze):
    snapshots = staging.stg_player_snapshots(bronze["players"], NOW)
    details = staging.stg_details_games(bronze["details"], NOW)
    trends = plan(intermediate.int_player_trends(snapshots, details, NOW))
    reads = re.findall(r"ReadSchema: struct<(.*)", trends)
    assert not any("player_count" in r and "raw_data" in r for r in reads)
    assert any("raw_data:struct<0:bigint,1:string,2:bigint" in r for r in reads)


def test_high_water_prunes_days_and_is_pushed_down(bronze):
    recent = newer_than(bronze["players"], datetime(2024, 1, 2), "snapshot_at", "snapshot_at_day")
    text = plan(staging.stg_player_snapshots(recent, NOW))
    assert re.search(r"PartitionFilters: \[.*snapshot_at_day#\d+ >= 20240102", text)
    assert "GreaterThan(snapshot_at,2024-01-02T00:00)" in text


def test_dim_games_needs_no_shuffle(enriched):
    df = dimensions.dim_games(enriched)
    assert "Exchange" not in plan(df) and "Join" not in plan(df)


def test_snapshot_fact_joins_without_shuffling(spark, bronze, star):
    rows = staging.stg_player_snapshots(bronze["players"], NOW)
    df = facts.fct_game_snapshots(rows, star, dimensions.dim_date(spark), NOW)
    assert shuffles(df) == 0 and plan(df).count("BroadcastHashJoin") == 2 and "BuildLeft" not in plan(df)


def test_achievement_fact_shuffles_once(spark, bronze, star):
    rows = staging.stg_player_achievements(bronze["players"], NOW)
    df = facts.fct_achievement_stats(rows, star, dimensions.dim_date(spark), NOW)
    assert shuffles(df) == 1 and "BuildLeft" not in plan(df)
    assert re.search(r"hashpartitioning\(app_id#\d+L, snapshot_at#\d+", plan(df))


def test_latest_time_is_an_aggregate_not_a_window(bronze):
    df = intermediate.int_games_enriched(
        staging.stg_details_games(bronze["details"], NOW),
        staging.stg_store_games(bronze["store"], NOW),
        staging.stg_player_snapshots(bronze["players"], NOW),
        NOW,
    )
    text = plan(df)
    assert "partial_max(snapshot_at" in text and "Subquery" in text
    assert text.count("Window [row_number()") == 2
