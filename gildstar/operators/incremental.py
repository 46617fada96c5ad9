"""Incremental fact loads: high-water filter, keyed upsert, schema sync.

A target is a folder of Parquet files and a list of numbered versions
(``sources.versions``).  Every load writes files of its own,
``data/load=<id>/<day column>=<day>``, and a version names the loads that hold
each day together with the schema they were written with.  Committing the next
version is the only moment at which a load shows: a driver lost before it
leaves the former version as it was, a reader keeps the version it opened, and
of two loads at once the later one sees that its version is taken and runs again
on top of the other.

A load rewrites only the days its batch touches.  Rows that cannot meet an old
key (``Target.appends``) are added beside a day's other loads without reading
them.  A column whose type changes is converted in those days only whose files
Parquet cannot read with the new type.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.functions.keys import date_key
from gildstar.session import few_listings, file_system, many_writers
from gildstar.sources import versions
from gildstar.sources.versions import CommitConflict

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_LOAD = "load"

# A day that this many loads have added to is merged by the next load that touches it.
MOST_LOADS_PER_DAY = 16
# How often a load runs again because others committed first.
MOST_ATTEMPTS = 50


class DuplicateKeyError(ValueError):
    """A batch holds the same merge key more than once."""


class IncompatibleTypeError(ValueError):
    """A column changed its type and stored values do not fit the new one."""


# --- DataFrame level -------------------------------------------------------


def newer_than(
    df: DataFrame, high: datetime | None, column: str, partition: str | None = None
) -> DataFrame:
    """L2: rows strictly newer than ``high``; None (no or empty target) keeps all.

    ``partition`` names an integer YYYYMMDD column of ``df`` derived from
    ``column``; comparing it as well prunes partitions and row groups, which a
    timestamp comparison alone does not.
    """
    if high is None:
        return df
    out = df.filter(F.col(column) > F.lit(str(high)).cast("timestamp_ntz"))
    if partition:
        out = out.filter(F.col(partition) >= F.lit(int(f"{high:%Y%m%d}")))
    return out


def sync_schema(target: DataFrame, batch_schema: T.StructType) -> DataFrame:
    """L4: the target with exactly the batch's columns and types; new columns are NULL.

    Values that do not fit a changed type become NULL; ``assert_convertible``
    tells before.
    """
    have = {f.name: f.dataType for f in target.schema.fields}

    def column(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name)

    return target.select(*[column(f) for f in batch_schema.fields])


def changed_types(before: T.StructType, after: T.StructType) -> dict[str, tuple[T.DataType, T.DataType]]:
    """Columns of both schemas whose types differ."""
    old = {f.name: f.dataType for f in before.fields}
    return {f.name: (old[f.name], f.dataType) for f in after.fields if f.name in old and old[f.name] != f.dataType}


def assert_convertible(df: DataFrame, schema: T.StructType) -> None:
    """Raise if a value of ``df`` has no counterpart in the changed types of ``schema``; reads these columns only.

    A value fits if its cast succeeds; a whole-number type must also hold it
    without dropping a fraction.
    """
    counts = []
    for name, (old, new) in changed_types(df.schema, schema).items():
        value = F.col(name)
        lost = value.try_cast(new).isNull()
        if isinstance(new, T.IntegralType) and isinstance(old, T.NumericType):
            lost = lost | (value.try_cast(new).try_cast(old) != value)
        counts.append(F.count_if(value.isNotNull() & lost).alias(name))
    if not counts:
        return
    try:
        row = df.agg(*counts).collect()[0].asDict()
    except AnalysisException as e:
        raise IncompatibleTypeError(f"no conversion: {e.getCondition()}") from e
    misfits = {name: n for name, n in row.items() if n}
    if misfits:
        raise IncompatibleTypeError(f"values that do not fit the new type, by column: {misfits}")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key repeats; reads the key columns only."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"batch repeats key {repeated[0].asDict()}")


def merge_upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], check: bool = True
) -> DataFrame:
    """L3: target rows whose key the batch lacks, plus the whole batch.

    Key columns must not be NULL; surrogate keys never are.
    """
    if check:
        assert_unique(batch, keys)
    kept = sync_schema(target, batch.schema).join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*batch.columns).unionByName(batch)


# --- stored targets --------------------------------------------------------


@dataclass(frozen=True)
class Target:
    """Where a fact lives and how it is keyed.

    ``partition`` must be a function of the key (the day of its snapshot), so
    that a row never moves to another partition.  With ``day_of``, a timestamp
    column, it is no column of the rows but the day of that time, which files
    are kept by: rows outside the calendar then have days of their own too.
    ``appends`` says that the key holds the watermark: a row above the
    high-water mark is then always new.
    """

    path: str
    keys: Sequence[str]
    watermark: str
    partition: str = "date_key"
    appends: bool = False
    day_of: str | None = None

    @property
    def data(self) -> str:
        return f"{self.path.rstrip('/')}/data"


def _day_name(day: int | None) -> str:
    return _NULL_PARTITION if day is None else str(day)


def _day_value(name: str) -> int | None:
    return None if name == _NULL_PARTITION else int(name)


def target_exists(spark: SparkSession, target: Target) -> bool:
    """L1: has a load of this target ever completed?"""
    return bool(versions.numbers(spark, target.path))


def _schema(state: dict) -> T.StructType:
    return T.StructType.fromJson(state["schema"])


def _read_days(
    spark: SparkSession, target: Target, schema: T.StructType, days: dict[str, list[dict]]
) -> DataFrame:
    """The files of some days' loads, read with one schema."""
    paths = [
        f"{target.data}/{_LOAD}={entry['load']}/{target.partition}={day}" for day, loads in days.items() for entry in loads
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    hidden = [T.StructField(_LOAD, T.StringType())]
    if target.day_of:
        hidden.append(T.StructField(target.partition, T.IntegerType()))
    whole = T.StructType([*schema.fields, *hidden])
    with few_listings(spark):
        stored = spark.read.schema(whole).option("basePath", target.data).parquet(*paths)
    return stored.drop(*[f.name for f in hidden])


def read_target(
    spark: SparkSession, target: Target, version: int | None = None, days: Iterable[int | None] | None = None
) -> DataFrame:
    """The target at its newest version, or at another one that is still kept.

    The frame stays at that version, whatever is loaded afterwards.  ``days``
    opens these partitions only.
    """
    if version is None:
        version, state = versions.current(spark, target.path)
    else:
        state = versions.state_of(spark, target.path, version)
    if state is None:
        raise FileNotFoundError(f"{target.path} has never been loaded")
    wanted = state["days"]
    if days is not None:
        names = {_day_name(d) for d in days}
        wanted = {d: loads for d, loads in wanted.items() if d in names}
    return _read_days(spark, target, _schema(state), wanted)


def high_water(spark: SparkSession, target: Target) -> datetime | None:
    """Newest watermark in the target, read from its newest day only.

    Rows without a day (outside the calendar) sit in the NULL partition, which
    is read too.
    """
    number, state = versions.current(spark, target.path)
    days = {_day_value(d) for d in state["days"]} if state else set()
    known = {d for d in days if d is not None}
    newest = ({max(known)} if known else set()) | (days & {None})
    if not newest:
        return None
    return read_target(spark, target, number, newest).agg(F.max(target.watermark)).collect()[0][0]


def _stored_schema(df: DataFrame, partition: str) -> T.StructType:
    """Columns as Parquet returns them: nullable, the partition column last."""
    columns = [c for c in df.columns if c != partition] + [c for c in df.columns if c == partition]
    return T.StructType([T.StructField(c, df.schema[c].dataType, True) for c in columns])


def _write(df: DataFrame, target: Target) -> str:
    """Write rows as a load of their own and return its id; nothing refers to it yet.

    The rebalance hint splits large days and merges small ones, as many as leave every core some.
    """
    load = uuid.uuid4().hex
    if target.day_of:
        df = df.withColumn(target.partition, date_key(target.day_of))
    with many_writers(df.sparkSession):
        (
            df.hint("rebalance", F.col(target.partition))
            .write.partitionBy(target.partition)
            .parquet(f"{target.data}/{_LOAD}={load}")
        )
    return load


def _days_of(spark: SparkSession, target: Target, load: str) -> list[str]:
    """Names of the days a load holds; one folder per day, so few whatever the data size."""
    fs, p = file_system(spark, f"{target.data}/{_LOAD}={load}")
    names = (status.getPath().getName() for status in fs.listStatus(p))
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{target.partition}=")]


def readable_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Can Parquet files of one type be read with another, to the value a cast would give?"""
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if stored == wanted:
        return True
    if type(stored) in whole and type(wanted) in whole:
        return whole.index(type(stored)) <= whole.index(type(wanted))
    if isinstance(wanted, T.DoubleType):
        return type(stored) in (T.ByteType, T.ShortType, T.IntegerType)
    return False


def _outdated(stored: T.StructType, before: T.StructType, after: T.StructType) -> bool:
    """Must files of a schema be rewritten when the target's schema changes?

    So they must if a type cannot be read any more, or if they hold values of a
    column that the target had dropped and that now returns empty.
    """
    kept = set(before.names)
    held = {f.name: f.dataType for f in stored.fields}
    return any(
        f.name in held and (f.name not in kept or not readable_as(held[f.name], f.dataType)) for f in after.fields
    )


@dataclass(frozen=True)
class _Staged:
    """A batch written and checked, but in no version yet."""

    load: str
    schema: T.StructType
    days: list[str]


def _stage(spark: SparkSession, batch: DataFrame, target: Target) -> _Staged:
    load = _write(batch, target)
    days, schema = _days_of(spark, target, load), _stored_schema(batch, target.partition)
    keys = _read_days(spark, target, schema, {d: [{"load": load}] for d in days})
    assert_unique(keys, target.keys)
    return _Staged(load, schema, days)


def _with_schema(state: dict, schema: T.StructType) -> int:
    """The position of a schema among those of the state's files, added if it is new."""
    form = json.loads(schema.json())
    if form not in state["schemas"]:
        state["schemas"].append(form)
    return state["schemas"].index(form)


def _merge(
    spark: SparkSession,
    target: Target,
    state: dict,
    staged: _Staged,
    replaced: frozenset[int],
    append: bool,
) -> dict:
    """The state after a staged batch; writes what must be merged or converted, commits nothing."""
    before, after = _schema(state), staged.schema
    old = {day: list(loads) for day, loads in state["days"].items()}
    outdated = [_outdated(T.StructType.fromJson(s), before, after) for s in state["schemas"]]
    new = {"schema": json.loads(after.json()), "schemas": list(state["schemas"]), "streams": dict(state["streams"])}
    mine = {"load": staged.load, "schema": _with_schema(new, after)}

    whole = {_day_name(d) for d in replaced}
    meet = [d for d in staged.days if d in old and d not in whole]
    merging = [d for d in meet if not append or len(old[d]) >= MOST_LOADS_PER_DAY]
    gone = set(merging) | (whole & set(staged.days))
    convert = {d: hit for d, loads in old.items() if d not in gone and (hit := [e for e in loads if outdated[e["schema"]]])}

    at_risk = {d: old[d] for d in merging} | convert
    assert_convertible(_read_days(spark, target, before, at_risk), after)
    days = {d: loads for d, loads in old.items() if d not in gone}
    if convert:
        rewritten = _write(sync_schema(_read_days(spark, target, before, convert), after), target)
        for d, hit in convert.items():
            days[d] = [e for e in days[d] if e not in hit] + [{"load": rewritten, "schema": mine["schema"]}]
    if merging:
        kept = _read_days(spark, target, before, {d: old[d] for d in merging})
        batch = _read_days(spark, target, after, {d: [mine] for d in merging})
        merged = _write(merge_upsert(kept, batch, target.keys, check=False), target)
        days |= {d: [{"load": merged, "schema": mine["schema"]}] for d in merging}
    for d in staged.days:
        if d not in merging:
            days[d] = [*days.get(d, []), mine]
    # Partitions given by the batch alone lose what they held, also if the batch has no row for them.
    return new | {"days": {d: loads for d, loads in days.items() if d not in whole or d in staged.days}}


def again(fn: Callable[[], DataFrame]) -> DataFrame:
    """Run a load, and run it again on top of whoever commits first."""
    for attempt in range(MOST_ATTEMPTS):
        try:
            return fn()
        except CommitConflict:
            if attempt + 1 == MOST_ATTEMPTS:
                raise
            time.sleep(min(2.0, 0.05 * (attempt + 1)))
    raise AssertionError("unreachable")


def load_incremental(
    spark: SparkSession,
    build: Callable[[datetime | None], DataFrame],
    target: Target,
    full_refresh: bool = False,
) -> DataFrame:
    """L1-L4: bring the target up to date and return it.

    ``build(high)`` gives the rows newer than ``high``; it gets None when there
    is no target yet, the target is empty, or ``full_refresh`` is set.  If
    another load commits meanwhile, the high-water mark is read and the rows are
    built again, so that two loads at once end as if one ran after the other.
    """

    def once() -> DataFrame:
        if full_refresh or not target_exists(spark, target):
            return load_full(spark, build(None), target, first=not full_refresh)
        number = versions.current(spark, target.path)[0]
        high = high_water(spark, target)
        return load_batch(spark, build(high), target, expected=number, append=target.appends and high is not None)

    return again(once)


def load_full(spark: SparkSession, df: DataFrame, target: Target, first: bool = False) -> DataFrame:
    """Replace the whole target; repeated keys leave it as it was.

    ``first`` gives way to a load that creates the target meanwhile (``CommitConflict``).
    """
    staged = _stage(spark, df, target)

    def once() -> DataFrame:
        number, state = versions.current(spark, target.path)
        if first and number:
            raise CommitConflict(f"{target.path} exists")
        form = json.loads(staged.schema.json())
        days = {d: [{"load": staged.load, "schema": 0}] for d in staged.days}
        streams = state["streams"] if state else {}
        number = versions.commit(
            spark, target.path, number, {"schema": form, "schemas": [form], "days": days, "streams": streams}
        )
        return read_target(spark, target, number)

    return once() if first else again(once)


def load_batch(
    spark: SparkSession,
    batch: DataFrame,
    target: Target,
    replaced: frozenset[int] = frozenset(),
    expected: int | None = None,
    append: bool = False,
    stream: tuple[str, int] | None = None,
) -> DataFrame:
    """Upsert a batch into the partitions it touches; the batch is written once, merged days once more.

    Rows already in a touched partition stay unless the batch has their key;
    ``append`` says that none can have, so nothing is read or merged.
    Partitions in ``replaced`` are given by the batch alone.  ``expected`` is the
    version the batch was made from: a newer one raises ``CommitConflict``;
    without it the merge is repeated on the newer one.  ``stream`` is a
    stream's name and its batch number, by which a batch loads once only.
    """
    if stream and (versions.current(spark, target.path)[1] or {}).get("streams", {}).get(stream[0], -1) >= stream[1]:
        return read_target(spark, target)
    staged = _stage(spark, batch, target)

    def once() -> DataFrame:
        number, state = versions.current(spark, target.path)
        if expected is not None and number != expected:
            raise CommitConflict(f"{target.path} has moved on from version {expected}")
        if state is None:
            raise FileNotFoundError(f"{target.path} has never been loaded")
        if stream and state["streams"].get(stream[0], -1) >= stream[1]:
            return read_target(spark, target, number)
        new = _merge(spark, target, state, staged, replaced, append)
        if stream:
            new["streams"][stream[0]] = stream[1]
        if new != state:
            number = versions.commit(spark, target.path, number, new)
        return read_target(spark, target, number)

    return once() if expected is not None else again(once)


def vacuum(spark: SparkSession, target: Target, keep: int = 3, orphan_hours: float = 48) -> None:
    """Drop all but the newest ``keep`` versions and the files that only they name.

    Loads in no version at all, left by lost drivers, go once they are older
    than ``orphan_hours``; no load may run that long.
    """
    gone, kept = versions.forget(spark, target.path, keep)

    def named(states: list[dict]) -> set[tuple[str, str]]:
        return {(e["load"], d) for s in states for d, loads in s["days"].items() for e in loads}

    live, old = named(kept), named(gone)
    for load, day in old - live:
        versions.delete(spark, f"{target.data}/{_LOAD}={load}/{target.partition}={day}")
    loads, known = {load for load, _ in live}, {load for load, _ in old}
    fs, p = file_system(spark, target.data)
    if not fs.exists(p):
        return
    limit = (time.time() - 3600 * orphan_hours) * 1000
    for status in fs.listStatus(p):
        load = status.getPath().getName().split("=", 1)[-1]
        if load not in loads and (load in known or status.getModificationTime() < limit):
            fs.delete(status.getPath(), True)
