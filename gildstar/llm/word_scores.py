"""Add-one unigram scores of words, the baseline beside which language models are read.

Counting and scoring follow the head-and-tail scheme of ``token_counts``: a table
of bounded size holds the most frequent short words and is summed where the text
is read; all other (row, word) pairs are joined with the counts by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.llm.common import encode_words, large_texts, slices, split_words

HEAD = 1 << 19
HEAD_CHARS = 32

_ROWS = pa.schema(
    [
        ("id", pa.int64()),
        ("h", pa.int64()),
        ("tail", pa.bool_()),
        ("word", pa.large_string()),
        ("n", pa.int64()),
        ("known", pa.int64()),
        ("logs", pa.float64()),
    ]
)


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    words, per_text = split_words(pc.ascii_lower(large_texts(part.column("text"))))
    codes, distinct = encode_words(words)
    return np.repeat(np.arange(part.num_rows), per_text), codes, distinct


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) of the training rows of (id, h, train, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            _, codes, distinct = _words(part)
            yield pa.RecordBatch.from_arrays(
                [distinct, pa.array(np.bincount(codes, minlength=len(distinct)).astype(np.int64))], names=["word", "c"]
            )

    counted = rows.filter("train").select("text").mapInArrow(count, "word string, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def word_scores(rows: DataFrame, folder: str) -> DataFrame:
    """(id, h, copies, n_tokens, n_known, train_tokens, base_score) per distinct (id, h) of ``rows``."""
    spark = rows.sparkSession
    word_counts(rows).write.parquet(f"{folder}/words")
    counts = spark.read.parquet(f"{folder}/words")
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    ends = rows.filter("train").count()
    total, distinct_tokens = n_words + ends, n_distinct + (ends > 0)
    top = counts.filter(F.length("word") <= HEAD_CHARS).orderBy(F.col("c").desc(), "word").limit(HEAD).toArrow()
    shared = spark.sparkContext.broadcast(dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist())))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for part in slices(batches, "text"):
            owner, codes, distinct = _words(part)
            names = distinct.to_pylist()
            c = np.array([head.get(w, -1) for w in names], np.int64)
            each = c[codes] if len(codes) else codes
            inside = each >= 0
            logs = np.bincount(owner[inside], np.log10(each[inside] + 1.0), part.num_rows)
            known = np.bincount(owner[inside], minlength=part.num_rows)
            width = max(1, len(names))
            pairs, n = np.unique(owner[~inside] * width + codes[~inside], return_counts=True)
            at = pa.array(pairs // width)
            ids, h = part.column("id"), part.column("h")
            spread = pa.array([f"{i}:{k}" for i, k in zip(ids.to_pylist(), h.to_pylist())], pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    h,
                    pa.array(np.zeros(part.num_rows, bool)),
                    spread,
                    pa.array(np.bincount(owner, minlength=part.num_rows).astype(np.int64)),
                    pa.array(known.astype(np.int64)),
                    pa.array(logs.astype(np.float64)),
                ],
                schema=_ROWS,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(at),
                    h.take(at),
                    pa.array(np.ones(len(pairs), bool)),
                    distinct.take(pa.array(pairs % width)).cast(pa.large_string()),
                    pa.array(n.astype(np.int64)),
                    pa.nulls(len(pairs), pa.int64()),
                    pa.nulls(len(pairs), pa.float64()),
                ],
                schema=_ROWS,
            )

    looked = rows.select("id", "h", "text").mapInArrow(
        look_up, "id long, h long, tail boolean, word string, n long, known long, logs double"
    )
    joined = looked.join(counts.select(F.lit(True).alias("tail"), "word", "c"), ["tail", "word"], "left")
    base = ~F.col("tail")
    summed = joined.groupBy("id", "h").agg(
        F.count(F.when(base, 1)).alias("copies"),
        F.max(F.when(base, F.col("n"))).alias("n_words"),
        F.sum(F.when(base, F.col("known")).when(F.col("c") > 0, F.col("n"))).alias("known"),
        F.sum(F.when(base, F.col("logs")).when(F.col("c") > 0, F.col("n") * F.log10(F.col("c") + 1.0))).alias("logs"),
    )
    n_tokens = F.col("n_words") + 1
    return summed.select(
        "id",
        "h",
        "copies",
        n_tokens.alias("n_tokens"),
        (F.coalesce(F.expr("known div copies"), F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (
            F.coalesce(F.col("logs") / F.col("copies"), F.lit(0.0))
            + F.log10(F.lit(ends + 1.0))
            - n_tokens * F.log10(F.lit(float(total + distinct_tokens + 1)))
        ).alias("base_score"),
    )
