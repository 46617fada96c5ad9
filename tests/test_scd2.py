"""Type-2 history."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gildstar.operators.incremental import read_target
from gildstar.operators.scd2 import history_target, load_scd2, scd2_apply, scd2_changes, scd2_start
from gildstar.sources import versions as stored_versions


def lost(*args, **kwargs):
    raise RuntimeError("driver lost")


def snap(spark, day, *rows):
    df = spark.createDataFrame(list(rows), "id int, price int, name string")
    return df.withColumn("seen", F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz"))


def versions(df):
    rows = [
        (r.id, r.price, r.valid_from.day, r.valid_to.day if r.valid_to else None, r.is_current) for r in df.collect()
    ]
    return sorted(rows, key=str)


def apply(history, snapshot):
    return scd2_apply(history, snapshot, ["id"], ["price"], "seen")


def test_change_and_return_to_the_old_price(spark):
    h = scd2_start(snap(spark, 1, (1, 10, "a"), (2, 5, "b")), ["id"], "seen")
    h = apply(h, snap(spark, 2, (1, 12, "a"), (2, 5, "b")))
    h = apply(h, snap(spark, 3, (1, 10, "a"), (3, 7, "c")))
    assert versions(h) == [
        (1, 10, 1, 2, False),
        (1, 10, 3, None, True),
        (1, 12, 2, 3, False),
        (2, 5, 1, None, True),
        (3, 7, 3, None, True),
    ]
    keys = [r.version_key for r in h.collect()]
    assert len(set(keys)) == len(keys)


def test_same_snapshot_twice_changes_nothing(spark):
    h = scd2_start(snap(spark, 1, (1, 10, "a")), ["id"], "seen")
    once = apply(h, snap(spark, 2, (1, 12, "a"), (2, 1, "b")))
    assert versions(apply(once, snap(spark, 2, (1, 12, "a"), (2, 1, "b")))) == versions(once)


def test_null_is_a_value_and_untracked_columns_do_not_matter(spark):
    h = scd2_start(snap(spark, 1, (1, None, "a"), (2, 3, "b")), ["id"], "seen")
    h = apply(h, snap(spark, 2, (1, None, "renamed"), (2, None, "b")))
    assert versions(h) == [(1, None, 1, None, True), (2, 3, 1, 2, False), (2, None, 2, None, True)]


def test_older_snapshot_is_ignored(spark):
    h = scd2_start(snap(spark, 5, (1, 10, "a")), ["id"], "seen")
    assert versions(apply(h, snap(spark, 4, (1, 99, "a")))) == versions(h)


def test_changes_leave_closed_history_out(spark):
    h = scd2_start(snap(spark, 1, (1, 10, "a")), ["id"], "seen")
    h = apply(h, snap(spark, 2, (1, 11, "a")))
    changed = scd2_changes(h.filter("is_current"), snap(spark, 3, (1, 12, "a")), ["id"], ["price"], "seen")
    assert versions(changed) == [(1, 11, 2, 3, False), (1, 12, 3, None, True)]
    assert changed.filter("valid_to IS NULL").collect()[0].valid_from == datetime(2024, 1, 3)


def test_stored_history_equals_the_operator_and_keeps_old_days(spark, tmp_path, monkeypatch):
    target = history_target(str(tmp_path / "h"))
    snaps = [
        snap(spark, 1, (1, 10, "a"), (2, 5, "b"), (4, 1, "d")),
        snap(spark, 2, (1, 12, "a"), (2, 5, "b")),
        snap(spark, 3, (1, 10, "a"), (3, 7, "c"), (4, 2, "d")),
        snap(spark, 3, (2, 6, "b")),
        snap(spark, 4, (2, 9, "b"), (9, None, "z")),
    ]
    want = scd2_start(snaps[0], ["id"], "seen")
    load_scd2(spark, snaps[0], target, ["id"], ["price"], "seen")
    for i, s in enumerate(snaps[1:], 1):
        want = apply(want, s).cache()
        if i == 4:
            closed = stored_versions.current(spark, target.path)[1]["days"]["20240103"]
            with monkeypatch.context() as patch:
                patch.setattr(stored_versions, "commit", lost)
                with pytest.raises(RuntimeError):
                    load_scd2(spark, s, target, ["id"], ["price"], "seen")
        load_scd2(spark, s, target, ["id"], ["price"], "seen")
        assert versions(read_target(spark, target)) == versions(want)
    assert stored_versions.current(spark, target.path)[1]["days"]["20240103"] == closed
    load_scd2(spark, snaps[-1], target, ["id"], ["price"], "seen")
    assert versions(read_target(spark, target)) == versions(want)
