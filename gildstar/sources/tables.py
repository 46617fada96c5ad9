"""Views and fully rebuilt tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gildstar.functions.ordering import Order, sort_columns
from gildstar.sources import versions

# Versions of a rebuilt table that stay readable.
KEEP = 2


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """A5: expose DataFrames to SQL as lazily evaluated views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_table(
    df: DataFrame,
    path: str,
    layout: Order = (),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Full rebuild; returns the stored table, which also cuts lineage.

    The rows go to a folder of their own, which becomes the table by one commit
    (``sources.versions``): until then readers see the former rebuild, and so
    they do for good if the driver is lost.  The version before the newest is
    kept for frames that still read it.

    ``layout`` orders rows inside each file (O1), which helps compression and
    row-group skipping.  It is not a promise to readers.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    folder = f"rows-{uuid.uuid4().hex}"
    out = df.sortWithinPartitions(*sort_columns(layout)) if layout else df
    writer = out.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{folder}")
    state = {"folder": folder, "schema": json.loads(df.schema.json())}
    while True:  # the last rebuild to commit wins
        try:
            number = versions.commit(spark, root, versions.current(spark, root)[0], state)
            break
        except versions.CommitConflict:
            continue
    for old in versions.forget(spark, root, KEEP)[0]:
        versions.delete(spark, f"{root}/{old['folder']}")
    return read_table(spark, root, df.schema, number)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None
) -> DataFrame:
    """A2: a stored model as a DataFrame, at its newest or a given version.

    A known schema replaces the stored one; a folder that ``write_table`` did
    not make is read as it is.
    """
    root = path.rstrip("/")
    state = versions.state_of(spark, root, version) if version else versions.current(spark, root)[1]
    if state is None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(root)
    return spark.read.schema(schema or T.StructType.fromJson(state["schema"])).parquet(f"{root}/{state['folder']}")
