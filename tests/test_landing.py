"""Checked landing: bad payloads set aside, ingestions landed once."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gildstar.plans.staging import MissingIdError, require_ids
from gildstar.queries.dataflows import stored_games
from gildstar.queries.registry import bronze
from gildstar.session import whole_variants
from gildstar.sources import landing
from gildstar.sources.bronze import as_variant, land_bronze, read_bronze
from gildstar.sources.landing import land_checked, read_rejects
from gildstar.streaming import stream_bronze

ENVELOPE = "load_id string, snapshot_at timestamp_ntz"
SCHEMA = f"{ENVELOPE}, raw_data string"
ROWS = [
    ("ok", datetime(2024, 1, 1), '{"players":{"player_count":1}}'),
    ("scalar", datetime(2024, 1, 2), "7"),
    ("absent", datetime(2024, 1, 2), None),
    ("undated", None, "{}"),
    ("cut", datetime(2024, 1, 2), '{"players":'),
    ("empty", datetime(2024, 1, 3), "  "),
    ("wild", datetime(2024, 1, 3), '{"a" 1}'),
]
GOOD = ["absent", "ok", "scalar", "undated"]
BAD = [("cut", "malformed JSON", '{"players":'), ("empty", "empty text", "  "), ("wild", "malformed JSON", '{"a" 1}')]


def state(spark, path, rejects):
    good = sorted(r.load_id for r in read_bronze(spark, path, schema=f"{SCHEMA.replace('raw_data string', 'raw_data variant')}").collect())
    bad = sorted((r.load_id, r._reason, r._payload) for r in read_rejects(spark, rejects, ENVELOPE).collect())
    return good, bad


@pytest.fixture()
def places(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "rejects")


@pytest.mark.parametrize("day_of", [None, "snapshot_at"])
def test_a_bad_payload_costs_one_row(spark, places, day_of):
    path, rejects = places
    raw = spark.createDataFrame(ROWS, SCHEMA)
    first = land_checked(raw, path, rejects, "a-1", day_of=day_of)
    assert (first.landed, first.rejected, first.repeated) == (4, 3, False)
    assert state(spark, path, rejects) == (GOOD, BAD)
    again = land_checked(raw, path, rejects, "a-1", day_of=day_of)
    assert (again.landed, again.rejected, again.repeated) == (4, 3, True)
    assert state(spark, path, rejects) == (GOOD, BAD)
    land_checked(raw.filter("load_id = 'ok'"), path, rejects, "a-2", day_of=day_of)
    assert state(spark, path, rejects) == (sorted([*GOOD, "ok"]), BAD)
    assert {r.landing for r in read_rejects(spark, rejects, ENVELOPE).collect()} == {"a-1"}


@pytest.mark.parametrize("step", ["create_text", "_move_all"])
@pytest.mark.parametrize("nth", [1, 2])
def test_interrupted_landing_goes_on(spark, places, monkeypatch, step, nth):
    path, rejects = places
    raw = spark.createDataFrame(ROWS, SCHEMA)
    owner = landing.versions if step == "create_text" else landing
    whole, calls = getattr(owner, step), []

    def lost(*args):
        calls.append(args)
        if len(calls) == nth:
            raise RuntimeError("driver lost")
        return whole(*args)

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, lost)
        with pytest.raises(RuntimeError):
            land_checked(raw, path, rejects, "a-1", day_of="snapshot_at")
    assert not land_checked(raw, path, rejects, "a-1", day_of="snapshot_at").repeated
    assert state(spark, path, rejects) == (GOOD, BAD)
    assert land_checked(raw, path, rejects, "a-1", day_of="snapshot_at").repeated


def test_lost_between_two_files(spark, places, monkeypatch):
    path, rejects = places
    raw = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    whole, calls = landing.file_system, []

    def lost(session, at):
        if "/part-" in at:
            calls.append(at)
            if len(calls) == 4:
                raise RuntimeError("driver lost")
        return whole(session, at)

    with monkeypatch.context() as patch:
        patch.setattr(landing, "file_system", lost)
        with pytest.raises(RuntimeError):
            land_checked(raw, path, rejects, "a-1", day_of="snapshot_at")
    land_checked(raw, path, rejects, "a-1", day_of="snapshot_at")
    assert state(spark, path, rejects) == (GOOD, BAD)


def test_nothing_staged_shows_and_streams_see_landed_rows(spark, places, tmp_path):
    path, rejects = places
    raw = spark.createDataFrame(ROWS, SCHEMA)
    land_checked(raw, path, rejects, "a-1", day_of="snapshot_at")
    versions_of = sorted(p.name for p in (tmp_path / "raw").iterdir() if not p.name.startswith("."))
    assert versions_of[-1] == "snapshot_at_day=__HIVE_DEFAULT_PARTITION__" and "_staged-a-1" not in versions_of
    stream = stream_bronze(spark, path, "load_id string, snapshot_at timestamp_ntz, raw_data variant, snapshot_at_day int")
    query = (
        stream.select("load_id").writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.load_id for r in spark.table("landed").collect()) == GOOD


def test_variant_payloads_and_empty_ingestions(spark, places):
    path, rejects = places
    raw = as_variant(spark.createDataFrame([r for r in ROWS if r[0] in GOOD], SCHEMA))
    assert land_checked(raw, path, rejects, "a-1").landed == 4
    assert land_checked(raw.filter(F.lit(False)), path, rejects, "a-2").landed == 0
    assert state(spark, path, rejects) == (GOOD, [])
    with pytest.raises(ValueError):
        land_checked(raw, path, rejects, "../a")


def test_a_wrong_id_path_fails(spark):
    raw = as_variant(spark.createDataFrame([("x", '{"store_id": 5}'), ("y", "{}"), ("z", None)], "load_id string, raw_data string"))
    require_ids(raw, "$.store_id", "raw_store")
    require_ids(raw.filter(F.lit(False)), "$.appid", "raw_store")
    with pytest.raises(MissingIdError):
        require_ids(raw, "$.appid", "raw_store")


def _stored_columns(folder: Path) -> set[str]:
    """Leaf columns of all Parquet files below a folder."""
    schemas = [pq.ParquetFile(f).schema for f in folder.rglob("*.parquet")]
    assert schemas
    return {schema.column(i).path for schema in schemas for i in range(len(schema))}


def test_whole_payloads_are_stored_as_they_are(spark, tmp_path):
    rows = [(f"l{i}", i, f'{{"players":{{"player_count":{i}}},"achievements":[{{"name":"a{i}","percent":{i}.5}}]}}') for i in range(50)]
    raw = spark.createDataFrame(rows, "load_id string, appid bigint, raw_data string")
    setting = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(setting)
    landed = land_bronze(raw, f"{tmp_path}/whole", whole=True)
    assert spark.conf.get(setting) == before
    assert _stored_columns(tmp_path / "whole") == {"load_id", "appid", "raw_data.value", "raw_data.metadata"}
    got = landed.selectExpr("load_id", "appid", "raw_data:players.player_count::bigint n", "raw_data:achievements[0].percent::double p")
    assert {tuple(r) for r in got.collect()} == {(f"l{i}", i, i, i + 0.5) for i in range(50)}


def test_the_setting_returns_after_a_failed_write(spark):
    setting = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(setting)
    with pytest.raises(RuntimeError), whole_variants(spark):
        assert spark.conf.get(setting) == "false"
        raise RuntimeError
    assert spark.conf.get(setting) == before


def test_queries_land_snapshots_whole_and_store_the_columns_they_read(spark, tmp_path):
    events = [(i, datetime(2024, 1, 1 + i % 3, 5), i % 4, "view" if i % 2 else "click", i * 1.25) for i in range(40)]
    parts = [(i, f"red box {i}", f"Brand#{i % 6}", "PROMO" if i % 2 else "STANDARD", i) for i in range(1, 20)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    landed = bronze(spark, str(tmp_path), "raw_players")
    folder = Path(landed.inputFiles()[0].removeprefix("file:")).parent
    assert not [c for c in _stored_columns(folder) if "typed_value" in c]

    few = stored_games(spark, str(tmp_path), "app_id", "genres_details")
    folder = Path(few.inputFiles()[0].removeprefix("file:")).parent
    assert _stored_columns(folder) == {"app_id", "genres_details"}
    every = stored_games(spark, str(tmp_path)).select("app_id", "genres_details")
    assert few.count() and sorted(few.collect(), key=str) == sorted(every.collect(), key=str)
