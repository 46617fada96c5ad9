"""Language-model scores by prediction with partial matching (operator 4).

The model is a trie of byte contexts up to ``ORDER`` bytes, filled from the
training rows.  A byte not seen after the longest context escapes to the next
shorter one (each distinct follower leaves half a count to the escape), whose
probabilities then leave out all followers already ruled out (symbol exclusion).
A text ends with an end byte, so probabilities of all texts add up to one.

The trie is a table of (ORDER + 1)-byte grams with counts, summed by Spark over
all training rows; shorter contexts are sums over it.  It is partitioned by the
last two context bytes, so each part holds whole branches and gives every gram
its log probability by itself; only contexts of one byte or none are shared,
a table of at most 65,536 counts.  Texts are scored in blocks, one per file split:
a block asks for its distinct grams only.  The most frequent grams are broadcast
in a table of bounded size, the rest travel to the block by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.llm.common import slices
from gildstar.llm.word_scores import word_scores
from gildstar.session import run_folder

ORDER = 5
HEAD = 1 << 19
# A byte that UTF-8 never uses: pads the beginning and marks the end.
_EDGE = 0xFF
_PAD = bytes([_EDGE]) * ORDER
PIECE_BYTES = 4 << 20


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, text position) for every predicted byte: its ORDER predecessors, then itself, as one number."""
    flat = np.frombuffer(b"".join(_PAD + t + _PAD[:1] for t in texts), np.uint8).astype(np.int64)
    code = np.zeros(max(0, len(flat) - ORDER), np.int64)
    for i in range(ORDER + 1):
        code = (code << 8) | flat[i : i + len(code)]
    # The code at place p predicts byte p + ORDER; of a text of n bytes, n + 1 places do.
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    owner = np.repeat(np.arange(len(texts)), sizes)
    places = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner] + starts[owner]
    return code[places], owner


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)


def _rows_of(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``keys`` in the sorted ``table`` and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class Level:
    """Contexts of one length: their entries, and totals and numbers of followers per context."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray):
        self.entries, self.counts = entries, counts.astype(np.float64)
        self.contexts, of = np.unique(entries >> 8, return_inverse=True)
        self.total = np.bincount(of, self.counts, len(self.contexts))
        self.followers = np.bincount(of, minlength=len(self.contexts)).astype(np.float64)
        self.of = of

    def ruled_out(self, longer: Level, mask: int) -> tuple[np.ndarray, np.ndarray]:
        """Per context of ``longer``: the counts here, and the number, of the followers it has seen."""
        at, _ = _rows_of(longer.entries & mask, self.entries)
        return np.bincount(longer.of, self.counts[at], len(longer.contexts)), longer.followers


def gram_scores(grams: np.ndarray, counts: np.ndarray, short: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of the last byte of each gram after its context.

    ``grams`` are sorted and hold whole branches from two context bytes on;
    ``short`` is the sorted table (one context byte and follower, count) of all.
    """
    seen = counts > 0
    levels: list[tuple[int, Level]] = []
    keys, sums = grams[seen], counts[seen]
    for length in range(ORDER, 1, -1):
        keys, sums = merged([keys & ((1 << 8 * (length + 1)) - 1)], [sums])
        levels.append((length, Level(keys, sums)))
    keys, sums = short
    levels.append((1, Level(keys, sums)))
    levels.append((0, Level(*merged([keys & 255], [sums]))))

    score = np.zeros(len(grams))
    open_ = np.ones(len(grams), bool)
    longer: tuple[int, Level] | None = None
    for length, level in levels:
        mask = (1 << 8 * (length + 1)) - 1
        entry = grams & mask
        row, known = _rows_of(entry >> 8, level.contexts)
        total = np.where(known, level.total[row] if len(level.total) else 0, 0.0)
        followers = np.where(known, level.followers[row] if len(level.followers) else 0, 0.0)
        if longer is not None:
            out, gone = level.ruled_out(longer[1], mask)
            row, known = _rows_of((grams & ((1 << 8 * (longer[0] + 1)) - 1)) >> 8, longer[1].contexts)
            if len(out):
                total = total - np.where(known, out[row], 0)
                followers = followers - np.where(known, gone[row], 0)
        at, hit = _rows_of(entry, level.entries)
        hit &= open_
        score[hit] += np.log10((level.counts[at[hit]] - 0.5) / total[hit])
        open_ &= ~hit
        escapes = open_ & (followers > 0)
        score[escapes] += np.log10(0.5 * followers[escapes] / total[escapes])
        longer = (length, level)
    rest = max(1, 256 - int(levels[-1][1].followers.sum()))
    score[open_] -= np.log10(rest)
    return score


def in_blocks(docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` with ``block``, the file split a row is read from; other inputs are written first."""
    split = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    try:
        return docs.withColumn("block", split)
    except AnalysisException:
        docs.write.parquet(f"{folder}/docs")
        return docs.sparkSession.read.parquet(f"{folder}/docs").withColumn("block", split)


def block_grams(rows: DataFrame) -> DataFrame:
    """(block, gram, n): the distinct grams of each block with their count in training rows (0 if in none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for part in slices(batches, "text", PIECE_BYTES):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            train = np.asarray(part.column("train"), bool)
            blocks = part.column("block").to_numpy()
            gram, owner = grams_of(texts)
            for block in np.unique(blocks).tolist():
                here = gram if (blocks == block).all() else gram[(blocks == block)[owner]]
                who = owner if len(here) == len(gram) else owner[(blocks == block)[owner]]
                marked, n = np.unique(here * 2 + train[who], return_counts=True)
                new = merged([marked >> 1], [n * (marked & 1)])
                old = kept.get(block)
                kept[block] = new if old is None else merged([old[0], new[0]], [old[1], new[1]])
        for block, (gram, n) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(gram), block)), pa.array(gram), pa.array(n)], names=["block", "gram", "n"]
            )

    return rows.select("block", "train", "text").mapInArrow(run, "block long, gram long, n long")


def model(grams: DataFrame) -> DataFrame:
    """(gram, n, score) of the distinct grams of (gram, n)."""
    short = (
        grams.filter("n > 0")
        .groupBy(F.expr("gram & 65535").alias("pair"))
        .agg(F.sum("n").alias("n"))
        .orderBy("pair")
        .toArrow()  # at most 256 * 256 rows
    )
    shared = grams.sparkSession.sparkContext.broadcast(
        (short.column("pair").to_numpy().astype(np.int64), short.column("n").to_numpy().astype(np.int64))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("gram").to_numpy(), b.column("n").to_numpy()) for b in batches]
        if not parts:
            return
        gram, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(gram)
        gram, n = gram[order], n[order]
        score = gram_scores(gram, n, shared.value)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n), pa.array(score)], names=["gram", "n", "score"])

    return grams.repartition(F.expr("(gram >> 8) & 65535")).mapInArrow(run, "gram long, n long, score double")


def ppm_scores(rows: DataFrame, folder: str) -> DataFrame:
    """(id, h, score) per row of (id, h, train, text, block)."""
    spark = rows.sparkSession
    block_grams(rows).write.parquet(f"{folder}/asked")
    asked = spark.read.parquet(f"{folder}/asked")
    asked.groupBy("gram").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/grams")
    model(spark.read.parquet(f"{folder}/grams")).write.parquet(f"{folder}/trie")
    trie = spark.read.parquet(f"{folder}/trie")
    top = trie.orderBy(F.col("n").desc(), "gram").limit(HEAD).select("gram", "score").toArrow()
    gram, score = top.column("gram").to_numpy(), top.column("score").to_numpy()
    order = np.argsort(gram)
    shared = spark.sparkContext.broadcast((gram[order], score[order].astype(np.float32)))

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value[0]
        for batch in batches:
            _, known = _rows_of(batch.column("gram").to_numpy(), head)
            yield batch.filter(pa.array(~known))

    asked_rare = asked.select("block", "gram").mapInArrow(rare, "block long, gram long")
    answers = asked_rare.join(trie.select("gram", F.col("score").cast("float").alias("score")), "gram")

    def score_block(
        docs: Iterator[pa.RecordBatch], answers: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        gram, score = shared.value
        own = [(b.column("gram").to_numpy(), b.column("score").to_numpy()) for b in answers]
        if own:
            gram = np.concatenate([gram, *[g for g, _ in own]])
            order = np.argsort(gram)
            gram, score = gram[order], np.concatenate([score, *[s for _, s in own]])[order]
        for part in slices(docs, "text", PIECE_BYTES):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            code, owner = grams_of(texts)
            distinct, inverse = np.unique(code, return_inverse=True)
            at, known = _rows_of(distinct, gram)
            if not known.all():
                raise ValueError("a block lacks grams it asked for")
            sums = np.bincount(owner, score[at].astype(np.float64)[inverse], len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("h"), pa.array(sums)], names=["id", "h", "score"]
            )

    return (
        rows.select("block", "id", "h", "text")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_grouped(score_block), "id long, h long, score double")
    )


def _grouped(score_block):
    """``score_block`` over whole tables of a block, as Spark hands them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = list(score_block(iter(left.to_batches()), iter(right.to_batches())))
        if not batches:
            schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("score", pa.float64())])
            return schema.empty_table()
        return pa.Table.from_batches(batches)

    return run


def score(docs: DataFrame, modulus: int = 7, held_remainder: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Held out are rows with crc32(doc_id as text) mod ``modulus`` =
    ``held_remainder``; the models learn from all others.  A NULL id counts as
    the empty text there and stays NULL.  A NULL text is an empty one.  ``score``
    is the log10 probability of the text's bytes, A-Z in lower case, and its end.
    Repeated rows are learnt and returned repeatedly; an empty table gives no
    rows; without training rows all bytes are equally likely.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "ppm")
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    held_out = F.crc32(key) % modulus == held_remainder
    rows = in_blocks(docs, folder).select(
        "block", F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("h"), (~held_out).alias("train"), lower.alias("text")
    )
    word_scores(rows, folder).write.parquet(f"{folder}/base")
    ppm_scores(rows, folder).groupBy("id", "h").agg(F.max("score").alias("score")).write.parquet(f"{folder}/scores")
    base = spark.read.parquet(f"{folder}/base")
    scores = spark.read.parquet(f"{folder}/scores")
    joined = base.join(
        scores.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "score"),
        F.expr("id <=> _id and h = _h"),
    )
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("id").alias(doc_id),
        (F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % modulus == held_remainder).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
