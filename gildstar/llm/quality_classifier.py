"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network (operator 10).

Every term has a fixed sparse random index vector.  A term's vector is the sum of
the index vectors of its neighbours over the whole corpus, counted in tasks and
summed by Spark.  Terms share a table of ``BUCKETS`` rows by hash, so the table
that goes to the driver and back to the tasks has a fixed size.  A document's
features are the mean of its terms' vectors.  The network is fitted on a bounded
sample of labelled rows and its probabilities are calibrated by a temperature.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.llm.common import encode_words, expand, giving_back, large_texts, mix64, slices, split_words
from gildstar.session import run_folder

BUCKETS = 1 << 14
DIMENSIONS = 64
NONZERO = 4
WINDOW = 2
SAMPLE_ROWS = 20_000  # labelled rows the network is fitted on, at most
HIDDEN = 32
EPOCHS = 60

# Pseudo-terms: an upper-case word, a word that repeats its predecessor.
_UPPER, _SAME = "\x00upper", "\x00same"


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % BUCKETS


def terms(word: str) -> list[int]:
    """Buckets of a word: its letters in lower case, its outer marks, and whether it is upper case."""
    core = word.strip(string.punctuation)
    out = []
    if core:
        out.append(_bucket(core.lower()))
        if len(core) > 1 and core.isupper():
            out.append(_bucket(_UPPER))
    marks = word.replace(core, " ", 1) if core else word
    out += [_bucket("\x00" + m) for m in marks.split() if m not in (",", ".")]
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of each bucket's index vector."""
    seed = np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(1)
    bits = mix64(seed * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, NONZERO)
    return (bits % np.uint64(DIMENSIONS)).astype(np.int64), np.where(bits >> np.uint64(63), 1.0, -1.0)


def term_sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text position, bucket) of all terms in order."""
    words, per_text = split_words(texts)
    codes, distinct = encode_words(words)
    owner = np.repeat(np.arange(len(texts)), per_text)
    plain = [terms(w) for w in distinct.to_pylist()]
    same = _bucket(_SAME)
    lists = plain + [p + [same] for p in plain]
    lengths = np.array([len(x) for x in lists], np.int64)
    flat = np.array([b for x in lists for b in x], np.int64)
    repeats = np.zeros(len(codes), bool)
    repeats[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    codes = codes + repeats * len(plain)
    if not len(codes):
        return owner, codes
    return np.repeat(owner, lengths[codes]), flat[expand(codes, np.cumsum(lengths) - lengths, lengths)]


def term_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The (BUCKETS, DIMENSIONS) table of term vectors, each of length 1 or 0."""
    columns = [f"v{i}" for i in range(DIMENSIONS)]
    schema = pa.schema([("bucket", pa.int32())] + [(c, pa.int64()) for c in columns])

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, sign = index_vectors()
        table = np.zeros(BUCKETS * DIMENSIONS)
        for part in slices(batches, "text"):
            owner, bucket = term_sequence(large_texts(part.column("text")))
            for step in range(1, WINDOW + 1):
                near = np.flatnonzero(owner[step:] == owner[:-step])
                for a, b in ((near, near + step), (near + step, near)):
                    row = bucket[a] * DIMENSIONS
                    for j in range(NONZERO):
                        table += np.bincount(row + position[bucket[b], j], sign[bucket[b], j], len(table))
        table = table.reshape(BUCKETS, DIMENSIONS)
        used = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32))]
            + [pa.array(table[used, i].astype(np.int64)) for i in range(DIMENSIONS)],
            schema=schema,
        )

    summed = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(count, ", ".join(["bucket int"] + [f"{c} long" for c in columns]))
        .groupBy("bucket")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .toArrow()
    )
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    if summed.num_rows:
        rows = np.stack([summed.column(c).to_numpy() for c in columns], 1).astype(np.float64)
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        vectors[summed.column("bucket").to_numpy()] = rows / np.maximum(norm, 1)
    return vectors.astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, features) per row of (doc_id, text): the mean term vector and the scaled number of terms.

    A column ``key`` of strings is handed on if there is one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    handed = [c for c in ("key",) if c in docs.columns]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("features", pa.list_(pa.float32())), *((c, pa.string()) for c in handed)]
    )

    @giving_back
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part in slices(batches, "text"):
            owner, bucket = term_sequence(large_texts(part.column("text")))
            n = np.bincount(owner, minlength=part.num_rows)
            sums = np.zeros((part.num_rows, DIMENSIONS + 1), np.float32)
            filled = np.flatnonzero(n)
            starts = (np.cumsum(n) - n)[filled]
            if len(filled):
                for d in range(DIMENSIONS):
                    sums[filled, d] = np.add.reduceat(table[:, d][bucket], starts, dtype=np.float64)
            sums[:, :DIMENSIONS] /= np.maximum(n, 1)[:, None]
            sums[:, DIMENSIONS] = np.log1p(n) / 10
            rows = pa.ListArray.from_arrays(
                np.arange(part.num_rows + 1, dtype=np.int32) * (DIMENSIONS + 1), sums.reshape(-1)
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), rows, *(part.column(c).cast(pa.string()) for c in handed)], schema=schema
            )

    return docs.mapInArrow(pool, ", ".join(["doc_id long", "features array<float>", *(f"{c} string" for c in handed)]))


@dataclass
class Network:
    """Scaling, two layers and the temperature of the output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Fit by Adam on four fifths of the rows, the temperature on the rest."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    if not len(x):
        return Network(np.zeros(d), np.ones(d), np.zeros((d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    order = rng.permutation(len(x))
    held = order[: len(x) // 5]
    used = order[len(x) // 5 :]
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-3
    z, t = (x[used] - mean) / scale, y[used].astype(float)
    net = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            step += 1
            a = np.tanh(z[rows] @ net[0] + net[1])
            error = (1 / (1 + np.exp(-np.clip(a @ net[2] + net[3], -500, 500))) - t[rows]) / len(rows)
            back = np.outer(error, net[2]) * (1 - a * a)
            slopes = [z[rows].T @ back + 1e-4 * net[0], back.sum(0), a.T @ error + 1e-4 * net[2], error.sum(keepdims=True)]
            for i, g in enumerate(slopes):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    fitted = Network(mean, scale, net[0], net[1], net[2], float(net[3][0]))
    if len(held):
        logits = fitted.logits(x[held])
        fitted.temperature = float(min(np.geomspace(0.5, 10, 60), key=lambda c: _loss(logits / c, y[held])))
    return fitted


def classify(
    docs: DataFrame,
    labels: DataFrame,
    modulus: int = 3,
    held_remainder: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    key: str | None = None,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, and its string column ``key`` if one is named.

    Held out are rows with crc32(doc_id as text) mod ``modulus`` =
    ``held_remainder``; their labels are never read.  A NULL id counts as the
    empty text there.  NULL and empty texts are scored from zero features.  Rows
    without a label, or with a NULL one, are scored but not learnt from; of
    repeated labels the largest counts.  Without labels every score is 0.5.
    Repeated rows are scored repeatedly; an empty table gives no rows.
    """
    spark = docs.sparkSession
    handed = [F.col(key).alias("key")] if key else []
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *handed)
    vectors = term_vectors(docs.select("doc_id", "text"))
    folder = f"{run_folder(spark, 'quality')}/features"
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == held_remainder
    pooled(docs, vectors).withColumn("held_out", held_out).write.parquet(folder)
    features = spark.read.parquet(folder)
    known = (
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("label is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sample = (
        features.filter(~F.col("held_out"))
        .join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "features")
        .limit(SAMPLE_ROWS)
        .select("features", "label")
        .toArrow()
    )
    x = np.array(sample.column("features").to_pylist(), np.float64).reshape(-1, DIMENSIONS + 1)
    shared = spark.sparkContext.broadcast(fit(x, sample.column("label").to_numpy()))

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, DIMENSIONS + 1)
            p = shared.value.probability(x.astype(np.float64))
            known = [batch.column(c) for c in ("doc_id", "held_out")]
            scored = [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [*known, *scored, *([batch.column("key")] if key else [])],
                names=["doc_id", "held_out", "score", "predicted", *(["key"] if key else [])],
            )

    columns = "doc_id long, held_out boolean, score double, predicted int" + (", key string" if key else "")
    out = features.mapInArrow(score, columns).withColumnRenamed("doc_id", doc_id)
    return out.withColumnRenamed("key", key) if key else out
