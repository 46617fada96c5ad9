"""Fact loads fed by a stream of bronze files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gildstar.functions.keys import date_key, surrogate_key
from gildstar.operators.incremental import Target, read_target
from gildstar.plans import staging
from gildstar.sources.bronze import land_bronze
from gildstar.streaming import load_stream, stream_bronze


def land(spark, path, *snaps):
    rows = [(f"l{a}", at, "api", a, n, at, f'{{"players":{{"player_count":{n}}}}}') for a, at, n in snaps]
    df = spark.createDataFrame(
        rows,
        "load_id string, ingested_at timestamp_ntz, source string, appid long, player_count long, "
        "snapshot_at timestamp_ntz, raw_data string",
    )
    return land_bronze(df, path, day_of="snapshot_at")


def fact(raw):
    rows = staging.stg_player_snapshots(raw, "2024-03-01 00:00:00")
    return rows.withColumn("snapshot_key", surrogate_key("app_id", "snapshot_at")).withColumn(
        "date_key", date_key("snapshot_at")
    )


def test_each_file_is_loaded_once(spark, tmp_path):
    path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "offsets")
    target = Target(str(tmp_path / "fact"), ["snapshot_key"], "snapshot_at")

    def run():
        stream = stream_bronze(spark, path, schema)
        load_stream(stream, fact, target, checkpoint).awaitTermination()
        got = read_target(spark, target).groupBy().agg(F.count("*"), F.sum("current_players")).collect()[0]
        return tuple(got)

    schema = land(spark, path, (1, datetime(2024, 1, 1, 10), 5), (2, datetime(2024, 1, 1, 10), 6)).schema
    assert run() == (2, 11)
    assert run() == (2, 11)
    land(spark, path, (1, datetime(2024, 1, 1, 11), 100), (2, datetime(2024, 1, 3, 10), 200), (3, datetime(2023, 1, 1), 9000))
    # A stream gives each file once, so late rows load as well.
    assert run() == (5, 9311)
    # Lost offsets: everything is read again, nothing is added again.
    checkpoint = str(tmp_path / "offsets2")
    assert run() == (5, 9311)


def test_unordered_files_one_by_one_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    target = Target(str(tmp_path / "fact"), ["snapshot_key"], "snapshot_at")
    hours = [(i * 7) % 24 for i in range(24)]
    for part in range(4):
        snaps = [(a, datetime(2024, 1, 1, h), 10 * a + h) for h in hours[part::4] for a in range(4)]
        schema = land(spark, path, *snaps).schema
    for checkpoint in ("first", "replayed"):
        stream = stream_bronze(spark, path, schema, files_per_batch=1)
        load_stream(stream, fact, target, str(tmp_path / checkpoint)).awaitTermination()
        assert read_target(spark, target).count() == 96
