"""Incremental loads: filters, upsert, schema sync, stored targets and recovery."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal
from functools import partial

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from gildstar.functions.keys import date_key
from gildstar.operators import incremental as inc
from gildstar.operators.incremental import (
    DuplicateKeyError,
    IncompatibleTypeError,
    Target,
    high_water,
    load_incremental,
    merge_upsert,
    newer_than,
    read_target,
    sync_schema,
    target_exists,
)
from gildstar.sources import versions
from gildstar.sources.tables import read_table, write_table

SCHEMA = "k string, at string, v int"


def batch(spark, *data, extra=None):
    df = spark.createDataFrame(list(data), SCHEMA).withColumn("at", F.col("at").cast("timestamp_ntz"))
    df = df.withColumn("date_key", F.when(F.col("at") < "2030-01-01", date_key("at")))
    return df if extra is None else df.withColumn(extra, F.lit("new"))


@pytest.fixture()
def target(tmp_path):
    return Target(str(tmp_path / "fact"), ["k"], "at")


def loaded(spark, target):
    return sorted((r.k, r.v) for r in read_target(spark, target).collect())


def source(df):
    return lambda high: newer_than(df, high, "at", "date_key")


def test_newer_than_is_strict(spark):
    df = batch(spark, ("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 10:00:01", 2), ("c", "2023-12-31 10:00:00", 3))
    high = datetime(2024, 1, 1, 10)
    assert [r.k for r in newer_than(df, high, "at").collect()] == ["b"]
    assert [r.k for r in newer_than(df, high, "at", "date_key").collect()] == ["b"]
    assert newer_than(df, None, "at").count() == 3


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert sorted(tuple(r) for r in merge_upsert(old, new, ["k"]).collect()) == [("a", 1), ("b", 20), ("c", 30)]
    with pytest.raises(DuplicateKeyError):
        merge_upsert(old, new.union(new), ["k"])


def test_sync_schema(spark):
    old = spark.createDataFrame([("a", 1)], "k string, gone int")
    want = spark.createDataFrame([], "k string, fresh double").schema
    got = sync_schema(old, want)
    assert got.schema["fresh"].dataType.simpleString() == "double" and got.collect()[0].asDict() == {"k": "a", "fresh": None}


def test_first_load_then_increment_then_nothing(spark, target):
    assert not target_exists(spark, target)
    first = batch(spark, ("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2))
    load_incremental(spark, source(first), target)
    assert loaded(spark, target) == [("a", 1), ("b", 2)]
    assert high_water(spark, target) == datetime(2024, 1, 2, 10)
    more = first.union(
        batch(
            spark,
            ("same", "2024-01-02 10:00:00", 9),
            ("late", "2024-01-01 11:00:00", 9),
            ("c", "2024-01-02 11:00:00", 3),
            ("d", "2024-01-05 00:00:00", 4),
        )
    )
    load_incremental(spark, source(more), target)
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    load_incremental(spark, source(more), target)
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_two_halves_equal_one_load(spark, tmp_path):
    rows = [(f"k{i}", f"2024-01-{1 + i // 5:02d} {i % 5:02d}:00:00", i) for i in range(50)]
    whole, parts = Target(str(tmp_path / "w"), ["k"], "at"), Target(str(tmp_path / "p"), ["k"], "at")
    load_incremental(spark, source(batch(spark, *rows)), whole)
    for n in (13, 27, 50):
        load_incremental(spark, source(batch(spark, *rows[:n])), parts)
    assert loaded(spark, whole) == loaded(spark, parts) and len(loaded(spark, parts)) == 50


def loads_by_day(spark, target):
    return {d: [e["load"] for e in loads] for d, loads in versions.current(spark, target.path)[1]["days"].items()}


def test_only_touched_days_are_rewritten(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2))), target)
    before = loads_by_day(spark, target)
    load_incremental(spark, source(batch(spark, ("c", "2024-01-02 11:00:00", 3))), target)
    after = loads_by_day(spark, target)
    assert after["20240101"] == before["20240101"] and after["20240102"] != before["20240102"]
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("c", 3)]


def test_key_in_target_is_replaced(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 10:30:00", 2))), target)
    again = batch(spark, ("a", "2024-01-01 11:00:00", 100))
    load_incremental(spark, source(again), target)
    assert loaded(spark, target) == [("a", 100), ("b", 2)]


def test_empty_target_loads_in_full(spark, target):
    load_incremental(spark, source(batch(spark).filter("false")), target)
    assert target_exists(spark, target) and high_water(spark, target) is None
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    assert loaded(spark, target) == [("a", 1)]


def test_duplicate_keys_leave_the_target_as_it_was(spark, target):
    twice = batch(spark, ("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-01 10:00:00", 2))
    with pytest.raises(DuplicateKeyError):
        load_incremental(spark, source(twice), target)
    assert not target_exists(spark, target)
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    with pytest.raises(DuplicateKeyError):
        load_incremental(spark, source(batch(spark, ("b", "2024-01-03 10:00:00", 1), ("b", "2024-01-03 10:00:00", 2))), target)
    assert loaded(spark, target) == [("a", 1)]


def test_full_refresh_with_repeated_keys_leaves_the_old_rows(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    twice = batch(spark, ("b", "2024-01-02 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2))
    with pytest.raises(DuplicateKeyError):
        load_incremental(spark, source(twice), target, full_refresh=True)
    assert target_exists(spark, target) and loaded(spark, target) == [("a", 1)]


def test_columns_come_and_go(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    load_incremental(spark, source(batch(spark, ("b", "2024-01-02 10:00:00", 2), extra="tag")), target)
    assert sorted((r.k, r.tag) for r in read_target(spark, target).collect()) == [("a", None), ("b", "new")]
    load_incremental(spark, source(batch(spark, ("c", "2024-01-02 11:00:00", 3))), target)
    assert "tag" not in read_target(spark, target).columns
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("c", 3)]


def test_rows_outside_the_calendar_count_for_the_mark(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1), ("z", "2031-01-01 10:00:00", 9))), target)
    assert high_water(spark, target) == datetime(2031, 1, 1, 10)
    assert read_target(spark, target).filter("date_key IS NULL").count() == 1


def test_full_refresh_rebuilds(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    load_incremental(spark, source(batch(spark, ("b", "2023-01-01 10:00:00", 2))), target, full_refresh=True)
    assert loaded(spark, target) == [("b", 2)]


class Lost(RuntimeError):
    pass


def losing(monkeypatch, nth):
    """The driver is lost at the nth step that writes: a load's files, a converted or merged day, or a commit."""
    steps = [0]

    def before(fn):
        def run(*args, **kwargs):
            steps[0] += 1
            if steps[0] == nth:
                raise Lost
            return fn(*args, **kwargs)

        return run

    patch = monkeypatch.context()
    m = patch.__enter__()
    m.setattr(inc, "_write", before(inc._write))
    m.setattr(versions, "commit", before(versions.commit))
    return patch, steps


FIRST = [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2)]
MORE = [("b2", "2024-01-02 11:00:00", 3), ("c", "2024-01-03 10:00:00", 4)]


@pytest.mark.parametrize("kind", ["batch", "refresh", "retyped"])
def test_lost_at_any_write_leaves_the_former_table(spark, tmp_path, monkeypatch, kind):
    nth = 0
    while True:
        nth += 1
        target = Target(str(tmp_path / f"fact{nth}"), ["k"], "at")
        load_incremental(spark, source(batch(spark, *FIRST)), target)
        opened = read_target(spark, target)
        new = batch(spark, *FIRST, *MORE)
        if kind == "retyped":
            new = new.withColumn("v", F.col("v").cast("string"))
        patch, steps = losing(monkeypatch, nth)
        try:
            load_incremental(spark, source(new), target, full_refresh=kind == "refresh")
            done = True
        except Lost:
            done = False
        finally:
            patch.__exit__(None, None, None)
        if not done:
            assert loaded(spark, target) == [("a", 1), ("b", 2)]
            # Whatever loads next finds the table whole: here an upsert as a stream would make it.
            inc.load_batch(spark, batch(spark, ("z", "2024-01-01 11:00:00", 9)), target)
            assert loaded(spark, target) == [("a", 1), ("b", 2), ("z", 9)]
        else:
            want = [("a", 1), ("b", 2), ("b2", 3), ("c", 4)]
            assert loaded(spark, target) == ([(k, str(v)) for k, v in want] if kind == "retyped" else want)
        # A frame opened before still reads its version.
        assert sorted((r.k, r.v) for r in opened.collect()) == [("a", 1), ("b", 2)]
        if done:
            assert nth == steps[0] + 1 >= 3
            break


def test_lost_first_load_starts_over(spark, target, monkeypatch):
    patch, _ = losing(monkeypatch, 2)
    with pytest.raises(Lost):
        load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    patch.__exit__(None, None, None)
    assert not target_exists(spark, target)
    load_incremental(spark, source(batch(spark, ("b", "2024-01-01 10:00:00", 2))), target)
    assert loaded(spark, target) == [("b", 2)]


def test_version_holds_the_schema(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1))), target)
    fields = versions.current(spark, target.path)[1]["schema"]["fields"]
    assert [f["name"] for f in fields] == ["k", "at", "v", "date_key"]


CHANGES = [
    ("int", "string", [(1, "1"), (None, None)]),
    ("string", "int", [("12", 12), (None, None)]),
    ("double", "decimal(10,2)", [(1.25, Decimal("1.25")), (None, None)]),
    ("int", "bigint", [(7, 7)]),
    ("int", "double", [(7, 7.0)]),
    ("bigint", "int", [(7, 7)]),
    ("double", "int", [(3.0, 3)]),
    ("date", "string", [(date(2024, 5, 6), "2024-05-06")]),
    ("decimal(10,2)", "decimal(12,4)", [(Decimal("1.25"), Decimal("1.2500"))]),
    ("struct<x:int>", "struct<x:string>", [((1,), ("1",))]),
]


def typed(spark, kind, rows):
    df = spark.createDataFrame([(k, at, v) for k, at, v in rows], f"k string, at string, v {kind}")
    df = df.withColumn("at", F.col("at").cast("timestamp_ntz"))
    return df.withColumn("date_key", date_key("at"))


@pytest.mark.parametrize("old,new,values", CHANGES)
def test_a_changed_type_reads_back_on_old_and_new_days(spark, target, old, new, values):
    inc.load_full(spark, typed(spark, old, [(f"k{i}", f"2024-01-0{1 + i} 10:00:00", v) for i, (v, _) in enumerate(values)]), target)
    newest = values[0][1]
    # The batch touches the first day, so that day is merged and the others are converted or read as they are.
    inc.load_batch(spark, typed(spark, new, [("new", "2024-01-01 12:00:00", newest), ("far", "2024-02-01 12:00:00", newest)]), target)
    got = {r.k: r.v for r in read_target(spark, target).collect()}
    want = {f"k{i}": v for i, (_, v) in enumerate(values)} | {"new": newest, "far": newest}
    assert {k: tuple(v) if isinstance(v, tuple) else v for k, v in got.items()} == want
    assert read_target(spark, target).schema["v"].dataType.simpleString() == new


def test_readable_types_convert_no_day(spark, target):
    inc.load_full(spark, typed(spark, "int", [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2)]), target)
    before = loads_by_day(spark, target)
    inc.load_batch(spark, typed(spark, "bigint", [("c", "2024-01-03 10:00:00", 2**40)]), target)
    after = loads_by_day(spark, target)
    assert {d: after[d] for d in before} == before and ("c", 2**40) in loaded(spark, target)
    # The next change starts from what readers see now, not from what the files hold.
    inc.load_batch(spark, typed(spark, "string", [("d", "2024-01-04 10:00:00", "x")]), target)
    assert loaded(spark, target) == [("a", "1"), ("b", "2"), ("c", str(2**40)), ("d", "x")]


def test_int_read_as_double_becomes_the_text_of_a_double(spark, target):
    for kind, value, day in (("int", 1, 1), ("double", 2.5, 2), ("string", "x", 3)):
        df = typed(spark, kind, [(kind, f"2024-01-0{day} 10:00:00", value)])
        (inc.load_batch if day > 1 else inc.load_full)(spark, df, target)
    assert loaded(spark, target) == [("double", "2.5"), ("int", "1.0"), ("string", "x")]


@pytest.mark.parametrize(
    "old,new,value,other",
    [
        ("string", "int", "twelve", 1),
        ("bigint", "int", 2**40, 1),
        ("double", "int", 1.5, 1),
        ("double", "decimal(4,2)", 1000.0, Decimal("1.00")),
        ("int", "struct<x:int>", 1, (1,)),
    ],
)
@pytest.mark.parametrize("day", [1, 5])
def test_values_that_do_not_fit_refuse_the_load(spark, target, old, new, value, other, day):
    inc.load_full(spark, typed(spark, old, [("a", "2024-01-01 10:00:00", value)]), target)
    with pytest.raises(IncompatibleTypeError):
        inc.load_batch(spark, typed(spark, new, [("b", f"2024-01-0{day} 12:00:00", other)]), target)
    assert loaded(spark, target) == [("a", value)]


def test_a_dropped_column_returns_empty(spark, target):
    load_incremental(spark, source(batch(spark, ("a", "2024-01-01 10:00:00", 1), extra="tag")), target)
    load_incremental(spark, source(batch(spark, ("b", "2024-01-02 10:00:00", 2))), target)
    load_incremental(spark, source(batch(spark, ("c", "2024-01-03 10:00:00", 3), extra="tag")), target)
    assert sorted((r.k, r.tag) for r in read_target(spark, target).collect()) == [("a", None), ("b", None), ("c", "new")]


def side_by_side(spark, *fns):
    with ThreadPoolExecutor(len(fns)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fn)) for fn in fns]]


def test_loads_at_once_end_as_if_one_ran_after_the_other(spark, target):
    parts = [batch(spark, (f"k{i}", f"2024-01-01 1{i}:00:00", i), ("same", "2024-01-01 09:00:00", i)) for i in range(4)]
    side_by_side(spark, *[partial(load_incremental, spark, lambda high, p=p: p, target) for p in parts])
    got = dict(loaded(spark, target))
    assert {k: v for k, v in got.items() if k != "same"} == {f"k{i}": i for i in range(4)} and got["same"] in range(4)
    assert versions.numbers(spark, target.path) == [1, 2, 3, 4]


def test_a_load_that_lost_the_race_reads_the_mark_again(spark, target):
    """Both want the same new rows; the second finds them loaded."""
    target = replace(target, appends=True)
    rows = batch(spark, *FIRST, *MORE)
    load_incremental(spark, source(batch(spark, *FIRST)), target)
    side_by_side(spark, *[partial(load_incremental, spark, source(rows), target)] * 3)
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("b2", 3), ("c", 4)]


def test_appends_write_each_row_once_and_read_no_day(spark, target, monkeypatch):
    target = replace(target, appends=True)
    load_incremental(spark, source(batch(spark, *FIRST)), target)
    before = loads_by_day(spark, target)
    patch, steps = losing(monkeypatch, 0)
    load_incremental(spark, source(batch(spark, *FIRST, *MORE)), target)
    patch.__exit__(None, None, None)
    assert steps[0] == 2  # the batch and the commit
    after = loads_by_day(spark, target)
    assert after["20240102"][:1] == before["20240102"] and len(after["20240102"]) == 2
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("b2", 3), ("c", 4)]
    load_incremental(spark, source(batch(spark, *FIRST, *MORE)), target)
    assert loaded(spark, target) == [("a", 1), ("b", 2), ("b2", 3), ("c", 4)]


def test_many_appends_to_a_day_are_merged(spark, target, monkeypatch):
    monkeypatch.setattr(inc, "MOST_LOADS_PER_DAY", 3)
    target = replace(target, appends=True)
    rows = [(f"k{i}", f"2024-01-01 {i:02d}:00:00", i) for i in range(8)]
    for n in range(1, 9):
        load_incremental(spark, source(batch(spark, *rows[:n])), target)
        assert len(loads_by_day(spark, target)["20240101"]) <= 3
    assert loaded(spark, target) == [(f"k{i}", i) for i in range(8)]


def test_hidden_day_spreads_rows_outside_the_calendar(spark, tmp_path):
    target = Target(str(tmp_path / "fact"), ["k"], "at", "at_day", appends=True, day_of="at")
    rows = [("a", "2024-01-01 10:00:00", 1), ("y", "2031-01-01 10:00:00", 8), ("z", "2031-01-02 10:00:00", 9)]
    load_incremental(spark, source(batch(spark, *rows)), target)
    assert sorted(loads_by_day(spark, target)) == ["20240101", "20310101", "20310102"]
    got = read_target(spark, target)
    assert got.columns == ["k", "at", "v", "date_key"] and got.filter("date_key is null").count() == 2
    assert high_water(spark, target) == datetime(2031, 1, 2, 10)


def test_vacuum_keeps_what_versions_name(spark, target, tmp_path):
    for n in range(1, 5):
        load_incremental(spark, source(batch(spark, *[(f"k{i}", f"2024-01-01 {i:02d}:00:00", i) for i in range(n)])), target)
    inc._write(batch(spark, ("orphan", "2024-01-01 10:00:00", 1)), target)
    inc.vacuum(spark, target, keep=2)
    assert versions.numbers(spark, target.path) == [3, 4]
    assert [read_target(spark, target, v).count() for v in (3, 4)] == [3, 4]
    folders = len(list((tmp_path / "fact" / "data").glob("load=*")))
    inc.vacuum(spark, target, keep=1, orphan_hours=0)
    assert loaded(spark, target) == [(f"k{i}", i) for i in range(4)]
    assert len(list((tmp_path / "fact" / "data").glob("load=*"))) == 1 < folders


def test_commits_are_compare_and_create(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.current(spark, root) == (0, None)
    assert versions.commit(spark, root, 0, {"n": 1}) == 1
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, root, 0, {"n": 2})
    assert versions.current(spark, root) == (1, {"n": 1})


def test_rebuilt_table_stays_readable_until_the_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    first = write_table(spark.range(3), path)

    def lost(*args):
        raise Lost

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lost)
        with pytest.raises(Lost):
            write_table(spark.range(50), path)
    assert read_table(spark, path).count() == 3
    write_table(spark.range(7), path)
    assert (first.count(), read_table(spark, path).count(), read_table(spark, path, version=1).count()) == (3, 7, 3)
    # A table may be rebuilt from itself.
    assert write_table(read_table(spark, path).filter("id < 5"), path).count() == 5


def test_many_days_are_listed_and_written_by_all_cores_not_a_task_each(spark, target):
    """Sixty days: listed by at most two tasks a core, written by several; settings are as before afterwards."""
    names = [
        "spark.sql.sources.parallelPartitionDiscovery.parallelism",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize",
    ]
    before = [spark.conf.get(n, None) for n in names]
    days = spark.range(6000).selectExpr(
        "cast(id as string) as k", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 60 as int)) as at", "uuid() as v"
    )
    inc.load_full(spark, days.withColumn("date_key", date_key("at")), target)
    writers = {f.rsplit("part-", 1)[1][:5] for f in read_target(spark, target).inputFiles()}
    assert len(writers) > 1
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        found = read_target(spark, target)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("listing")]
    tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert tasks and max(tasks) <= 2 * sc.defaultParallelism
    assert found.count() == 6000
    assert [spark.conf.get(n, None) for n in names] == before


def test_settings_held_by_several_threads_are_restored(spark):
    from gildstar.session import many_writers

    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name, None)
    first, second = many_writers(spark), many_writers(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "16k"
    second.__exit__(None, None, None)
    assert spark.conf.get(name, None) == before
