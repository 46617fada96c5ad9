"""Helpers the training-data operators share: Arrow slices of texts, word splitting, counted offsets."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Text bytes that a task holds in working arrays at one time.
SLICE_BYTES = 8 << 20

# The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"\x20\x09-\x0D"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, besides their own paths."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the C library keep most of it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def giving_back(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that frees its working arrays for others when its task ends.

    Spark keeps Python workers for later tasks, beside whose sorts and joins they would hold an earlier stage's most.
    """

    @functools.wraps(run)
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` bytes of ``text``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // limit
        bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Like ``slices``, but small batches are put together first until they hold about ``limit`` bytes."""

    def joined(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return slices(pa.Table.from_batches(parts).combine_chunks().to_batches(), text, limit)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pc.sum(pc.fill_null(pc.binary_length(batch.column(text)), 0)).as_py()
        if size >= limit:
            yield from joined(held)
            held, size = [], 0
    if held:
        yield from joined(held)


def large_texts(column: pa.Array) -> pa.Array:
    """The texts as large strings of their own, NULL as the empty text.

    Some kernels go wrong on strings whose first byte is not the buffer's first,
    as in slices; taking all rows copies them.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.take(pa.array(np.arange(len(column)))).cast(pa.large_string()), "")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The white-space separated words of all texts in order, and how many each text has."""
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), np.diff(lists.offsets.to_numpy())
    # Splitting leaves an empty part before leading and after trailing white space.
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))
    if not filled.all():
        owner = np.repeat(np.arange(len(offsets)), offsets)
        offsets = np.bincount(owner[filled], minlength=len(offsets))
        flat = flat.filter(pa.array(filled))
    return flat, offsets.astype(np.int64)


def encode_words(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dictionary positions and the dictionary of ``words``."""
    encoded = words.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def expand(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions in a packed list of lists that ``codes`` stand for, one list after the other."""
    n = lengths[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts[codes] - (ends - n), n) + np.arange(total)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers (wraps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
