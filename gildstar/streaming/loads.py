"""The incremental fact load (L1-L4) with new bronze files found by a stream.

The stream gives each file once, so its micro-batches are not filtered by a
high-water mark: the mark would move with every micro-batch, and files that
follow in any order would lose their older rows.  Each micro-batch is upserted
by key into the days it touches, in one commit that also notes its number.  A
micro-batch replayed after a lost driver is recognised by it; one replayed under
another checkpoint replaces its own rows.  Nothing is added twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gildstar.operators.incremental import Target, load_batch, load_incremental, target_exists


def stream_bronze(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """A stored raw table as a stream of its new files, in arrival order."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def load_stream(
    raw: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    target: Target,
    checkpoint: str,
) -> StreamingQuery:
    """Load everything that has arrived, then stop (``availableNow``).

    ``build`` turns raw rows into fact rows.  Rows that arrive late are loaded too.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not target_exists(spark, target):
            # An empty first version, so that the batch commits together with its number.
            load_incremental(spark, lambda _high: build(batch).limit(0), target)
        load_batch(spark, build(batch), target, stream=(checkpoint, number))

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
