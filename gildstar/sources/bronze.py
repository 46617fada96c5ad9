"""A1: raw tables of envelope columns plus one JSON payload."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.functions.keys import date_key
from gildstar.session import whole_variants
from gildstar.sources.landing import REJECT_COLUMNS

# Envelope columns of the raw tables, payload last.  No model reads
# the ranking table.
ENVELOPES = {
    "raw_top100": "load_id string, ingested_at timestamp_ntz, source string, endpoint string, "
    "appid bigint, raw_data variant",
    "raw_details": "load_id string, ingested_at timestamp_ntz, source string, endpoint string, "
    "appid bigint, raw_data variant",
    "raw_store": "load_id string, ingested_at timestamp_ntz, source string, endpoint string, "
    "appid bigint, country_code string, raw_data variant",
    "raw_players": "load_id string, ingested_at timestamp_ntz, source string, appid bigint, "
    "player_count bigint, snapshot_at timestamp_ntz, raw_data variant",
}


def as_variant(df: DataFrame, payload: str = "raw_data") -> DataFrame:
    """Parse a JSON text payload to VARIANT; a VARIANT payload passes through."""
    if isinstance(df.schema[payload].dataType, T.VariantType):
        return df
    return df.withColumn(payload, F.parse_json(payload))


def read_bronze(
    spark: SparkSession, path: str, payload: str = "raw_data", fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """A1: a raw table with its payload as VARIANT.

    ``fmt`` is any Spark file source.  Payloads stored as text are parsed per
    query; ``land_bronze`` parses them once, ``land_checked`` also sets bad ones
    aside.
    """
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return as_variant(reader.load(path).drop(*REJECT_COLUMNS), payload)


def land_bronze(
    df: DataFrame,
    path: str,
    payload: str = "raw_data",
    day_of: str | None = None,
    mode: str = "append",
    compact: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Store a raw table with its payload parsed to VARIANT, and read it back.

    ``day_of`` names a timestamp column; its day becomes the integer partition
    column ``<day_of>_day``, which lets incremental reads prune old days.

    Landing is a narrow job: an ingestion covers few days, so each task writes
    few files.  ``compact`` shuffles by day first, for backfills of many days.
    ``whole`` stores payloads as they are, for those read by their arrays;
    otherwise Spark may give each field a column, so that others are not read.
    """
    out = as_variant(df, payload)
    day = f"{day_of}_day"
    with whole_variants(df.sparkSession) if whole else nullcontext():
        if day_of is None:
            out.write.mode(mode).parquet(path)
        else:
            dated = out.withColumn(day, date_key(day_of))
            if compact:
                dated = dated.hint("rebalance", F.col(day))
            dated.write.mode(mode).partitionBy(day).parquet(path)
    schema = T.StructType(out.schema.fields + ([T.StructField(day, T.IntegerType())] if day_of else []))
    return df.sparkSession.read.schema(schema).parquet(path)
