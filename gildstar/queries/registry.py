"""Name -> query registry and the input tables queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.session import file_system, run_folder
from gildstar.sources import derived
from gildstar.sources.bronze import land_bronze

# Fixed value: the load time stamped by every registered query.
LOAD_TS = "2024-03-01 00:00:00"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name with its SQL counterpart."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_landed: dict[tuple, tuple[str, T.StructType]] = {}

# A file below this size per core is read by fewer tasks than there are cores.
_SPLIT_BYTES = 128 * 1024 * 1024

# Input table and, for tables that grow with every ingestion, the time their day comes from.
_BRONZE_INPUT = {
    "raw_details": ("part", None),
    "raw_store": ("part", None),
    "raw_players": ("events", "snapshot_at"),
}


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived raw table, landed once per session with its payload as VARIANT.

    The landed copy is keyed by the state of its input file, so changed input
    is landed anew.
    """
    source, day_of = _BRONZE_INPUT[name]
    fs, path = file_system(spark, f"{sf_dir}/{source}.parquet")
    size = fs.getContentSummary(path).getLength()  # of all parts, if the table is a folder
    key = (
        spark.sparkContext.applicationId,
        sf_dir,
        name,
        size,
        fs.getFileStatus(path).getModificationTime(),
    )
    if key not in _landed:
        path = f"{run_folder(spark, 'bronze')}/{name}"
        cores = spark.sparkContext.defaultParallelism
        few_splits = size < cores * _SPLIT_BYTES
        raw = derived.RAW_TABLES[name](spark, sf_dir, spread=cores if few_splits else None)
        # What grows with every ingestion is mostly arrays of achievements, which fields of their own do not help.
        _landed[key] = (path, land_bronze(raw, path, day_of=day_of, whole=day_of is not None).schema)
    path, schema = _landed[key]
    return spark.read.schema(schema).parquet(path)


def publish(df: DataFrame, *drop: str) -> DataFrame:
    """Comparable output: decimals as double, doubles at six digits, no VARIANT."""
    columns = []
    for f in df.schema.fields:
        if f.name in drop or isinstance(f.dataType, T.VariantType):
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        columns.append(c.alias(f.name))
    return df.select(*columns)
