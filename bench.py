"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) names the input,
``BENCH_CPUS`` (default: all) the local cores, ``BENCH_RUNS`` (default 3) the
timed runs per query after one warm-up; the median counts.  Every query runs to
the end over all its rows and columns (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gildstar.plans.build import build  # noqa: E402
from gildstar.queries import REGISTRY  # noqa: E402
from gildstar.queries.registry import LOAD_TS  # noqa: E402
from gildstar.session import build_session, run_folder  # noqa: E402
from gildstar.sources import derived  # noqa: E402
from gildstar.sources.bronze import land_bronze  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "stg_details_games",
    "stg_store_games",
    "stg_player_snapshots",
    "stg_player_achievements",
    "int_games_enriched",
    "int_player_trends",
    "dim_date",
    "dim_genre",
    "dim_developer",
    "dim_games",
    "fct_game_snapshots",
    "fct_achievement_stats",
    "daily_trend",
    "J1_typed_paths",
    "J5_explode_array",
    "J6_J8_explode_object",
    "W1_latest_per_key",
    "W4_top_k_per_group",
    "W4_G5_top_tags_in_row",
    "W6_lag",
    "G1_order_rollup",
    "N4_dimension_lookup",
    "N11_star_join",
    "T3_T7_S5_S6_calendar",
    "L3_merge_upsert",
    "L6_scd2",
    "C2_unique",
    "C4_lineitem_orders",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "gildstar-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}

    def measure(name: str, fn, runs: int = RUNS) -> None:
        fn()
        results[name] = round(statistics.median(timed(fn) for _ in range(runs)), 3)
        print(f"{name}: {results[name]}", file=sys.stderr, flush=True)

    def land() -> dict:
        folder = run_folder(spark, "bench-bronze")
        return {
            name: land_bronze(
                raw(spark, SF_DIR, int(CPUS)), f"{folder}/{name}", day_of="snapshot_at" if name == "raw_players" else None
            )
            for name, raw in derived.RAW_TABLES.items()
        }

    measure("land_bronze", land)
    bronze = land()
    measure("full_build", lambda: build(spark, bronze, run_folder(spark, "bench-build"), LOAD_TS))
    for name in HEADLINE:
        measure(name, lambda: run(REGISTRY[name].run(spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
