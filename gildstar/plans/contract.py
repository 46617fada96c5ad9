"""The 122 declared column checks of the thirteen models."""

from __future__ import annotations

from gildstar.operators.quality import Check

# Accepted labels.
PRICE_TIERS = ["free", "budget", "mid", "premium", "aaa"]
DIFFICULTIES = ["common", "uncommon", "rare", "ultra_rare"]
REVIEW_LABELS = [
    "Overwhelmingly Positive",
    "Very Positive",
    "Mostly Positive",
    "Mixed",
    "Mostly Negative",
    "Overwhelmingly Negative",
]
TRENDS = ["growing", "stable", "declining", "first_snapshot"]
GENRE_CATEGORIES = ["core_genre", "monetization_model", "release_state", "other"]

# Per model the columns that must be non-NULL, the columns that must
# be unique, accepted values, inclusive ranges, and references to other models.
CONTRACT = {
    "stg_details_games": {
        "not_null": ["app_id", "name", "price_usd", "_ingested_at", "_loaded_at"],
        "unique": ["app_id"],
        "between": {
            "price_usd": (0, 999),
            "discount_pct": (0, 100),
            "current_players": (0, None),
            "positive_reviews": (0, None),
            "negative_reviews": (0, None),
            "review_score": (0, 1),
        },
    },
    "stg_store_games": {
        "not_null": [
            "app_id",
            "name",
            "is_free",
            "is_early_access",
            "platform_windows",
            "platform_mac",
            "platform_linux",
            "_ingested_at",
            "_loaded_at",
        ],
        "unique": ["app_id"],
        "accepted_values": {"is_early_access": [True, False]},
        "between": {"price_eur": (0, 999), "discount_pct": (0, 100)},
    },
    "stg_player_snapshots": {
        "not_null": ["app_id", "snapshot_at", "_ingested_at", "_loaded_at"],
        "between": {"current_players": (0, None)},
    },
    "stg_player_achievements": {
        "not_null": [
            "app_id",
            "achievement_name",
            "unlock_pct",
            "snapshot_at",
            "_ingested_at",
            "_loaded_at",
        ],
        "accepted_values": {"difficulty_label": DIFFICULTIES},
        "between": {"unlock_pct": (0, 100)},
    },
    "int_games_enriched": {
        "not_null": [
            "app_id",
            "name",
            "is_free",
            "price_tier",
            "review_score_label",
            "platform_windows",
            "platform_mac",
            "platform_linux",
            "is_multi_platform",
            "snapshot_at",
            "_loaded_at",
        ],
        "accepted_values": {"price_tier": PRICE_TIERS, "review_score_label": REVIEW_LABELS},
        "between": {"discount_pct": (0, 100), "review_score": (0, 1)},
    },
    "int_player_trends": {
        "not_null": ["app_id", "name", "trend_label", "snapshot_at", "_loaded_at"],
        "accepted_values": {"trend_label": TRENDS},
        "between": {"current_players": (0, None)},
    },
    "dim_price_tier": {
        "not_null": ["price_tier_key", "tier_label", "min_price_usd", "display_order"],
        "unique": ["price_tier_key", "tier_label"],
        "accepted_values": {"tier_label": PRICE_TIERS},
    },
    "dim_date": {
        "not_null": ["date_key", "full_date", "year", "month", "day_of_week", "is_weekend"],
        "unique": ["date_key", "full_date"],
        "between": {"month": (1, 12)},
    },
    "dim_genre": {
        "not_null": ["genre_key", "genre_name", "genre_category"],
        "unique": ["genre_key", "genre_name"],
        "accepted_values": {"genre_category": GENRE_CATEGORIES},
    },
    "dim_developer": {
        "not_null": ["developer_key", "developer_name", "is_indie", "total_games"],
        "unique": ["developer_key", "developer_name"],
        "between": {"total_games": (1, None)},
    },
    "dim_games": {
        "not_null": ["game_key", "app_id", "name", "price_tier", "is_free", "is_current", "valid_from"],
        "unique": ["game_key"],
        "accepted_values": {"price_tier": PRICE_TIERS},
    },
    "fct_game_snapshots": {
        "not_null": ["snapshot_key", "game_key", "date_key", "snapshot_at"],
        "unique": ["snapshot_key"],
        "between": {
            "current_players": (0, None),
            "review_score": (0, 1),
            "price_usd": (0, None),
            "discount_pct": (0, 100),
        },
        "relationships": {"game_key": ("dim_games", "game_key"), "date_key": ("dim_date", "date_key")},
    },
    "fct_achievement_stats": {
        "not_null": [
            "stat_key",
            "game_key",
            "date_key",
            "achievement_name",
            "unlock_pct",
            "difficulty_label",
            "difficulty_rank",
            "snapshot_at",
        ],
        "unique": ["stat_key"],
        "accepted_values": {"difficulty_label": DIFFICULTIES},
        "between": {"unlock_pct": (0, 100)},
        "relationships": {"game_key": ("dim_games", "game_key"), "date_key": ("dim_date", "date_key")},
    },
}


def contract_checks(models: list[str] | None = None) -> list[Check]:
    """The declared checks, optionally of some models only."""
    out: list[Check] = []
    for model, spec in CONTRACT.items():
        if models is not None and model not in models:
            continue
        out += [Check(model, c, "not_null") for c in spec.get("not_null", [])]
        out += [Check(model, c, "unique") for c in spec.get("unique", [])]
        out += [
            Check(model, c, "accepted_values", values=v)
            for c, v in spec.get("accepted_values", {}).items()
        ]
        out += [
            Check(model, c, "between", low=lo, high=hi)
            for c, (lo, hi) in spec.get("between", {}).items()
        ]
        out += [
            Check(model, c, "relationships", parent=p, parent_column=pc)
            for c, (p, pc) in spec.get("relationships", {}).items()
        ]
    return out
