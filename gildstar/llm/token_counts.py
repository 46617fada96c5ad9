"""Token counts per document without making ids (operator 3).

Each distinct pre-token of the corpus is encoded once to learn its number of
pieces.  Per-document pre-token frequencies are then joined to that table and
summed.  The join has two legs, alike at every size: the ``HEAD`` most frequent
short pre-tokens (a table of bounded size) go to the tasks as a broadcast and
are summed where the text is read; all others are joined by shuffle.  As the
frequent ones never reach the shuffle, no join key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.llm.common import large_texts, slices
from gildstar.llm.pretokens import BytePretokens
from gildstar.session import run_folder

HEAD = 1 << 18
HEAD_CHARS = 32  # so the broadcast holds at most HEAD * 32 characters

_PIECES = pa.schema([("piece", pa.large_string()), ("freq", pa.int64())])
_COUNTED = pa.schema([("piece", pa.large_string()), ("freq", pa.int64()), ("pieces", pa.int32())])
_ROWS = pa.schema(
    [
        ("id", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("tail", pa.bool_()),
        ("piece", pa.large_string()),
        ("n", pa.int64()),
        ("n_bytes", pa.int64()),
    ]
)


def text_keys(texts: list[str]) -> np.ndarray:
    """The 128-bit hash of each text as two signed integers, one row per text."""
    digests = b"".join(xxhash.xxh3_128_digest(t.encode()) for t in texts)
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def vocabulary(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Distinct pre-tokens of the corpus with frequency and number of tokens: (piece, freq, pieces)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = BytePretokens(path)
        for part in slices(batches, "text"):
            known, _, units, _ = cutter.of_texts(large_texts(part.column("text")))
            freq = np.bincount(units, minlength=len(known)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(known, pa.large_string()), pa.array(freq)], schema=_PIECES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = BytePretokens(path)
        for batch in batches:
            pieces = [cutter.count(p) for p in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece").cast(pa.large_string()), batch.column("freq"), pa.array(pieces, pa.int32())],
                schema=_COUNTED,
            )

    return (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(cut, "piece string, freq long")
        .groupBy("piece")
        .agg(F.sum("freq").alias("freq"))
        .mapInArrow(count, "piece string, freq long, pieces int")
    )


def count_tokens(
    docs: DataFrame, path: str, limit: int, doc_id: str = "doc_id", text: str = "text", head: int = HEAD
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    A NULL text counts as empty; a NULL id stays NULL; repeated rows give
    repeated results, also under one id; an empty table gives no rows.  Special
    strings inside texts count as the library takes them, one token each.
    Rows of one id are told apart by a 128-bit hash of their text.
    Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    spark = docs.sparkSession
    folder = f"{run_folder(spark, 'token-counts')}/vocabulary"
    vocabulary(docs, path, text).write.parquet(folder)
    counted = spark.read.parquet(folder)
    top = (
        counted.filter(F.length("piece") <= HEAD_CHARS)
        .orderBy(F.col("freq").desc(), "piece")
        .limit(head)
        .select("piece", "pieces")
        .toArrow()
    )
    shared = spark.sparkContext.broadcast(
        dict(zip(top.column("piece").to_pylist(), top.column("pieces").to_pylist()))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known_counts = BytePretokens(path), shared.value
        for part in slices(batches, "text"):
            texts = large_texts(part.column("text"))
            known, owner, units, special = cutter.of_texts(texts)
            pieces = np.array([known_counts.get(p, -1) for p in known], np.int64)
            each = pieces[units] if len(units) else units
            in_head = each >= 0
            summed = np.bincount(owner[in_head], each[in_head], len(texts)).astype(np.int64) + special
            pairs, freq = np.unique(owner[~in_head] * max(1, len(known)) + units[~in_head], return_counts=True)
            at, unit = pairs // max(1, len(known)), pairs % max(1, len(known))
            ids = part.column("id").cast(pa.int64())
            keys = text_keys(texts.to_pylist())
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            spread = pa.array([f"{i}:{c}" for i, c in zip(ids.to_pylist(), keys[:, 0].tolist())], pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    *(pa.array(keys[:, c]) for c in (0, 1)),
                    pa.array(np.zeros(len(texts), bool)),
                    spread,
                    pa.array(summed),
                    n_bytes,
                ],
                schema=_ROWS,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(at)),
                    *(pa.array(keys[at, c]) for c in (0, 1)),
                    pa.array(np.ones(len(at), bool)),
                    pa.array(known, pa.large_string()).take(pa.array(unit)),
                    pa.array(freq.astype(np.int64)),
                    pa.nulls(len(at), pa.int64()),
                ],
                schema=_ROWS,
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        look_up, "id long, h1 long, h2 long, tail boolean, piece string, n long, n_bytes long"
    )
    # The row of each text itself carries its own key as piece, which spreads these rows over the tasks.
    joined = rows.join(
        counted.select(F.lit(True).alias("tail"), "piece", "pieces"), ["tail", "piece"], "left"
    )
    per_row = (
        joined.groupBy("id", "h1", "h2")
        .agg(
            F.count("n_bytes").alias("copies"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_all"),
        )
        .withColumn("n_tokens", F.expr("n_all div copies"))
    )
    return per_row.select(
        F.col("id").alias(doc_id),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
