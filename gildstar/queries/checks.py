"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.operators import quality
from gildstar.plans.build import build
from gildstar.plans.contract import contract_checks
from gildstar.queries.dataflows import achievements, snapshots
from gildstar.queries.registry import LOAD_TS, bronze, publish, register, table
from gildstar.queries.sqltext import with_ctes
from gildstar.session import run_folder


@register(
    "C1_not_null",
    with_ctes("stg_achievements")
    + "SELECT app_id, snapshot_at, achievement_name FROM stg_achievements WHERE unlock_pct IS NULL",
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = quality.not_null(achievements(spark, sf_dir), "unlock_pct")
    return failing.select("app_id", "snapshot_at", "achievement_name")


@register(
    "C2_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@register(
    "C3_accepted_values",
    "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')",
)
def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return quality.accepted(events, "event_type", ["view", "click", "purchase"])


@register(
    "C4_foreign_key",
    """SELECT user_id, count(*) AS n_records FROM events
       WHERE user_id NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'STANDARD') GROUP BY user_id""",
)
def foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "part").filter("p_type <> 'STANDARD'")
    return quality.foreign_key(table(spark, sf_dir, "events"), "user_id", parents, "p_partkey")


@register(
    "C4_lineitem_orders",
    """SELECT l_orderkey, count(*) AS n_records FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""",
)
def foreign_key_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return quality.foreign_key(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


@register(
    "C5_between",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08",
)
def between(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return quality.between(lines, "l_discount", 0.02, 0.08)


@register(
    "C7_reconcile",
    with_ctes("players")
    + """SELECT app_id, snapshot_at, current_players, player_count_raw FROM players
         WHERE current_players IS DISTINCT FROM player_count_raw""",
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots(spark, sf_dir).select("app_id", "snapshot_at", "current_players", "player_count_raw")
    return quality.reconcile(rows, "current_players", "player_count_raw")


# Model name -> expression that defines it in the SQL counterpart.
_MODEL_SQL = {
    "stg_details_games": "stg_details",
    "stg_store_games": "stg_store",
    "stg_player_snapshots": "players",
    "stg_player_achievements": "stg_achievements",
    "int_games_enriched": "games",
    "int_player_trends": "trends",
    "dim_price_tier": "dim_price_tier",
    "dim_date": "dim_date",
    "dim_genre": "dim_genre",
    "dim_developer": "dim_developer",
    "dim_games": "dim_games",
    "fct_game_snapshots": "fct_snapshots",
    "fct_achievement_stats": "fct_achievements",
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _check_sql(check: quality.Check) -> str:
    model, column = f"m_{check.model}", check.column
    if check.kind == "not_null":
        n = f"SELECT count(*) FROM {model} WHERE {column} IS NULL"
    elif check.kind == "unique":
        n = f"SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    elif check.kind == "accepted_values":
        values = ", ".join(_literal(v) for v in check.values)
        n = f"SELECT count(*) FROM {model} WHERE {column} NOT IN ({values})"
    elif check.kind == "between":
        tests = [f"{column} < {check.low}"] if check.low is not None else []
        tests += [f"{column} > {check.high}"] if check.high is not None else []
        n = f"SELECT count(*) FROM {model} WHERE {' OR '.join(tests)}"
    else:
        n = (
            f"SELECT count(*) FROM {model} c WHERE {column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM m_{check.parent} p WHERE p.{check.parent_column} = c.{column})"
        )
    return (
        f"SELECT '{check.model}' AS model, '{column}' AS column_name, '{check.kind}' AS check_kind, ({n}) AS n_failed"
    )


def _suite_sql() -> str:
    stamped = {"stg_details", "stg_store", "players", "stg_achievements"}
    models = ",\n".join(
        f"m_{model} AS MATERIALIZED (SELECT *"
        + (f", TIMESTAMP '{LOAD_TS}' AS _loaded_at" if cte in stamped else "")
        + f" FROM {cte})"
        for model, cte in _MODEL_SQL.items()
    )
    body = "\nUNION ALL ".join(_check_sql(c) for c in contract_checks())
    return with_ctes(*_MODEL_SQL.values()) + ",\n" + models + "\n" + body


@register("C6_check_suite", _suite_sql())
def suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build from landed bronze, then all declared checks on its models."""
    raw = {name: bronze(spark, sf_dir, name) for name in ("raw_details", "raw_store", "raw_players")}
    models = build(spark, raw, run_folder(spark, "suite"), LOAD_TS)
    return publish(quality.run_checks(models, contract_checks()))
