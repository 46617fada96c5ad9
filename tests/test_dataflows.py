"""The thirteen dataflows on hand-written bronze rows with the edge cases."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from gildstar.operators.quality import run_checks
from gildstar.plans import dimensions, intermediate, staging
from gildstar.plans.build import build
from gildstar.plans.contract import contract_checks
from gildstar.sources.bronze import as_variant

NOW = "2024-03-01 00:00:00"
T = [datetime(2024, 1, d) for d in range(1, 32)]


def details_doc(appid=1, **over):
    doc = {
        "appid": appid, "name": f"Game {appid}", "developer": "Dev", "publisher": "Pub",
        "price": "999", "initialprice": "1999", "discount": "50", "ccu": 10,
        "average_forever": 1, "average_2weeks": 2, "median_forever": 3, "median_2weeks": 4,
        "positive": 90, "negative": 10, "owners": "10,000 .. 20,000", "genre": "Action, Indie",
        "languages": "English", "tags": {"Fast": 3, "Fun": 5},
    }
    doc.update(over)
    return {k: v for k, v in doc.items() if v is not ...}


def store_doc(appid=1, **over):
    doc = {
        "appid": appid, "name": f"Store {appid}", "type": "game", "short_description": "s",
        "developers": ["A", "B"], "publishers": ["P"],
        "price_overview": {"currency": "EUR", "final": 899, "initial": 1799, "discount_percent": 50},
        "is_free": False, "release_date": {"date": "21 Aug, 2012", "coming_soon": False},
        "genres": [{"id": "1", "description": "Action"}], "categories": [{"id": 2}],
        "platforms": {"windows": True, "mac": False, "linux": False},
        "supported_languages": "English", "website": None,
    }
    doc.update(over)
    return {k: v for k, v in doc.items() if v is not ...}


def raw_details(spark, *loads):
    rows = [(l, t, "s", "e", d.get("appid"), json.dumps(d)) for l, t, d in loads]
    return as_variant(spark.createDataFrame(
        rows, "load_id string, ingested_at timestamp_ntz, source string, endpoint string, appid long, raw_data string"))


def raw_store(spark, *loads):
    rows = [(l, t, "s", "e", d.get("appid"), "es", json.dumps(d)) for l, t, d in loads]
    return as_variant(spark.createDataFrame(
        rows,
        "load_id string, ingested_at timestamp_ntz, source string, endpoint string, appid long, country_code string, raw_data string"))


def raw_players(spark, *snaps):
    rows = [(f"p{i}", at, "s", app, n, at, json.dumps(doc)) for i, (app, at, n, doc) in enumerate(snaps)]
    return as_variant(spark.createDataFrame(
        rows,
        "load_id string, ingested_at timestamp_ntz, source string, appid long, player_count long, snapshot_at timestamp_ntz, raw_data string"))


def ach(*items):
    return {"achievements": {"achievements": [dict(zip(("name", "percent"), i)) for i in items]}}


def by_id(df):
    return {r.app_id: r for r in df.collect()}


def test_details_dedupe_and_types(spark):
    raw = raw_details(
        spark,
        ("a", T[0], details_doc(1, name="old")), ("b", T[1], details_doc(1, name="new")),
        ("a", T[0], details_doc(2, name="low")), ("b", T[0], details_doc(2, name="high")),
        ("a", None, details_doc(3, name="null time")), ("b", T[5], details_doc(3, name="timed")),
        ("a", T[0], details_doc(..., name="no id")),
        ("a", T[0], details_doc(4, positive=0, negative=0)), ("a", T[0], details_doc(5, positive=...)),
        ("a", T[0], details_doc(6, price="0", discount=...)),
    )
    got = by_id(staging.stg_details_games(raw, NOW))
    assert {k: r.name for k, r in got.items() if k < 4} == {1: "new", 2: "high", 3: "null time"}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert got[1].price_usd == Decimal("9.99") and got[1].initial_price_usd == Decimal("19.99")
    assert got[1].review_score == 0.9 and got[4].review_score is None and got[5].review_score is None
    assert got[6].price_usd == 0 and got[6].discount_pct is None
    assert got[1]._loaded_at == datetime(2024, 3, 1)


def test_store_fields(spark):
    raw = raw_store(
        spark,
        ("a", T[0], store_doc(1)),
        ("a", T[0], store_doc(2, price_overview=None, is_free=True, developers=[], genres=[{"description": "Early Access"}])),
        ("a", T[0], store_doc(3, genres=..., developers=...)),
        ("a", T[0], store_doc(4)), ("b", T[1], store_doc(4, name="later")),
    )
    got = by_id(staging.stg_store_games(raw, NOW))
    assert (got[1].developer, got[1].price_eur, got[1].discount_pct) == ("A", Decimal("8.99"), 50)
    assert (got[2].developer, got[2].price_eur, got[2].currency, got[2].is_free) == (None, None, None, True)
    assert [got[i].is_early_access for i in (1, 2, 3)] == [False, True, False]
    assert got[3].developer is None and got[4].name == "later"


def test_store_id_path_can_be_named(spark):
    raw = raw_store(spark, ("a", T[0], {**store_doc(...), "other_id": 9}))
    assert list(by_id(staging.stg_store_games(raw, NOW, id_path="$.other_id"))) == [9]


def test_snapshots_and_achievements(spark):
    raw = raw_players(
        spark,
        (1, T[0], 5, {"players": {"player_count": 6}, **ach(("x", 50.0), ("y", 20), ("z", 5.0), ("w", 4.9), ("v", None))}),
        (1, T[0], 5, {"players": {}}), (None, T[0], 5, ach(("q", 1.0))), (2, None, 5, {}),
        (3, T[1], 7, {"achievements": {"achievements": []}}), (4, T[1], 7, {"achievements": None}),
        (5, T[1], 7, ach((None, 3.0))),
    )
    snaps = staging.stg_player_snapshots(raw, NOW).collect()
    assert sorted((r.app_id, r.current_players, r.player_count_raw or 0) for r in snaps) == [
        (1, 5, 0), (1, 5, 6), (3, 7, 0), (4, 7, 0), (5, 7, 0)]
    got = {r.achievement_name: r.difficulty_label for r in staging.stg_player_achievements(raw, NOW).collect()}
    assert got == {"x": "common", "y": "uncommon", "z": "rare", "w": "ultra_rare", "v": "ultra_rare"}


@pytest.fixture(scope="module")
def enriched(spark):
    details = raw_details(
        spark,
        ("a", T[0], details_doc(1)),
        ("a", T[0], details_doc(2, price="0")),
        ("a", T[0], details_doc(3, price="0")),
        ("a", T[0], details_doc(4, price=..., owners="n/a", positive=...)),
        ("a", T[0], details_doc(5, price="4000", genre="Action, Free To Play, ", tags=[])),
        ("a", T[0], details_doc(6, genre="", tags=None)),
        ("a", T[0], details_doc(7, genre=..., tags=..., developer=...)),
        ("a", T[0], details_doc(8, tags={c: 5 if c in "ef" else i + 6 for i, c in enumerate("abcdef")} | {"g": 1})),
    )
    store = raw_store(
        spark,
        ("a", T[0], store_doc(1, platforms={"windows": True, "mac": True, "linux": False})),
        ("a", T[0], store_doc(3, is_free=False)),
        ("a", T[0], store_doc(9)),
        ("a", T[0], store_doc(8, platforms={"windows": False, "mac": False, "linux": False})),
    )
    players = raw_players(spark, (1, T[3], 5, {}), (1, T[4], 6, {}), (2, T[2], 5, {}), (99, T[9], 1, {}))
    return intermediate.int_games_enriched(
        staging.stg_details_games(details, NOW),
        staging.stg_store_games(store, NOW),
        staging.stg_player_snapshots(players, NOW),
        NOW,
    ).cache()


def test_enriched_games(enriched):
    got = by_id(enriched)
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert (got[1].name, got[1].developer, got[2].name, got[2].developer) == ("Store 1", "A", "Game 2", "Dev")
    assert (got[2].is_free, got[2].price_tier) == (True, "free")
    assert (got[3].is_free, got[3].price_tier) == (False, "budget")
    assert (got[4].is_free, got[4].price_tier, got[4].owners_min) == (None, "aaa", None)
    assert got[5].price_tier == "aaa" and got[1].price_tier == "mid"
    assert (got[1].owners_min, got[1].owners_max) == (10000, 20000)
    assert got[4].review_score_label == "Overwhelmingly Negative" and got[4].total_reviews is None
    assert [(got[i].is_multi_platform, got[i].has_any_platform) for i in (1, 3, 8, 2)] == [
        (True, True), (False, True), (False, False), (False, False)]
    assert [got[i].snapshot_at for i in (1, 2, 3)] == [T[4], T[2], T[9]]


def test_dimensions(spark, enriched):
    games = by_id(dimensions.dim_games(enriched))
    assert [(games[i].primary_genre, games[i].all_genres) for i in (1, 5, 6, 7)] == [
        ("Action", "Action, Indie"), ("Action", "Action, Free To Play, "), ("", ""), ("Unknown", "Unknown")]
    assert [games[i].top_tags for i in (1, 5, 6, 7, 8)] == ["Fun, Fast", "", "", "", "d, c, b, a, e"]
    assert (games[1].valid_from, games[1].valid_to, games[1].is_current) == (T[4], None, True)

    genres = {r.genre_name: r.genre_category for r in dimensions.dim_genre(enriched).collect()}
    assert genres == {"Action": "core_genre", "Indie": "core_genre", "Free To Play": "monetization_model"}

    devs = {r.developer_name: r for r in dimensions.dim_developer(enriched).collect()}
    assert sorted(devs) == ["A", "Dev"]
    assert (devs["A"].total_games, devs["A"].publisher_name, devs["A"].is_indie) == (3, "P", True)
    assert (devs["Dev"].total_games, devs["Dev"].avg_review_score, devs["Dev"].total_current_players) == (4, 0.9, 40)


def test_calendar(spark):
    cal = {r.full_date: r for r in dimensions.dim_date(spark).collect()}
    assert len(cal) == 4018 and max(cal) == date(2030, 12, 31)
    assert dimensions.dim_date(spark, include_end=False).count() == 4017
    day = cal[date(2024, 12, 30)]
    assert (day.date_key, day.week, day.quarter_label, day.month_name, day.day_name, day.day_of_week, day.is_weekend) == (
        20241230, 1, "2024-Q4", "Dec", "Mon", 2, False)
    assert cal[date(2024, 6, 1)].is_weekend and cal[date(2024, 6, 2)].is_weekend and cal[date(2024, 6, 3)].is_weekday
    assert [tuple(r) for r in dimensions.dim_price_tier(spark).filter("price_tier_key = 5").collect()] == [(5, "aaa", 40.0, None, 5)]


def test_trends(spark):
    details = staging.stg_details_games(raw_details(spark, ("a", T[0], details_doc(1))), NOW)
    counts = [100, 110, 99, 99, 0, 50, None, 7]
    players = raw_players(spark, *[(1, T[i], n, {}) for i, n in enumerate(counts)], (77, T[0], 3, {}))
    got = intermediate.int_player_trends(staging.stg_player_snapshots(players, NOW), details, NOW).collect()
    mine = sorted((r for r in got if r.app_id == 1), key=lambda r: r.snapshot_at)
    assert [r.trend_label for r in mine] == [
        "first_snapshot", "growing", "declining", "stable", "declining", "stable", "stable", "first_snapshot"]
    assert [r.players_delta for r in mine] == [None, 10, -11, 0, -99, 50, None, None]
    assert mine[5].players_pct_change is None
    unknown = [r for r in got if r.app_id == 77]
    assert len(unknown) == 1 and unknown[0].name is None


def clean_bronze(spark, days):
    return {
        "raw_details": raw_details(spark, *[("a", T[0], details_doc(i)) for i in (1, 2, 3)]),
        "raw_store": raw_store(spark, *[("a", T[0], store_doc(i)) for i in (1, 2)]),
        "raw_players": raw_players(
            spark, *[(i, T[d], 10 * i + d, {"players": {"player_count": 1}, **ach(("a", 60.0), ("b", 3.0), ("c", 3.0))})
                     for i in (1, 2, 3) for d in days]),
    }


def test_build_passes_its_contract_and_loads_incrementally(spark, tmp_path):
    out = str(tmp_path)
    models = build(spark, clean_bronze(spark, range(3)), out, NOW)
    failed = run_checks(models, contract_checks()).filter("n_failed > 0").collect()
    assert failed == []
    assert models["fct_game_snapshots"].count() == 9 and models["fct_achievement_stats"].count() == 27
    ranks = models["fct_achievement_stats"].select("achievement_name", "difficulty_rank").distinct().collect()
    assert sorted(tuple(r) for r in ranks) == [("a", 3), ("b", 1), ("c", 2)]

    later = build(spark, clean_bronze(spark, range(5)), out, "2024-03-02 00:00:00")
    assert later["fct_game_snapshots"].count() == 15
    stamps = later["fct_game_snapshots"].groupBy("_loaded_at").count().collect()
    assert sorted(r["count"] for r in stamps) == [6, 9]

    whole = build(spark, clean_bronze(spark, range(5)), str(tmp_path / "whole"), NOW)
    for name in ("fct_game_snapshots", "fct_achievement_stats"):
        a = later[name].drop("_loaded_at")
        b = whole[name].select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_defaults_and_unknown_games(spark, tmp_path):
    bronze = {
        "raw_details": raw_details(
            spark, ("a", T[0], details_doc(1, genre=..., developer=...)), ("a", T[0], details_doc(2, discount=...))),
        "raw_store": raw_store(spark, ("a", T[0], store_doc(50))),
        "raw_players": raw_players(
            spark, (1, T[0], 1, {}), (2, datetime(2031, 1, 1), 2, {}), (2, datetime(2030, 12, 31, 23), 3, {}), (404, T[0], 3, {})),
    }
    import hashlib

    unknown = hashlib.md5(b"Unknown").hexdigest()
    rows = build(spark, bronze, str(tmp_path), NOW)["fct_game_snapshots"].collect()
    got = {r.current_players: r for r in rows}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].genre_key, got[1].developer_key, got[1].price_tier_key) == (unknown, unknown, 3)
    assert got[2].date_key is None and got[3].date_key == 20301231
    assert (got[1].is_on_sale, got[2].is_on_sale, got[1].owners_midpoint) == (True, None, 15000.0)
