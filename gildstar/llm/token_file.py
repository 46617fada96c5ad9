"""Token-id files: texts to ids in ascending document order, entropy-coded (operator 1).

Documents are range-partitioned and sorted by id, so file after file the ids
ascend.  Each task tokenises its documents slice by slice and writes one frame
(see ``rans``) per slice: blocks of whole documents that share a table.  A frame
is a row of a Parquet table with its own table, states, checkpoints, checksums
and payload, so any row decodes alone.  Spark's commit protocol makes the write
safe against lost executors, and no step needs all ids at one place.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gildstar.llm import rans
from gildstar.llm.common import encode_words, expand, giving_back, large_texts, slices, split_words
from gildstar.llm.pretokens import byte_level, load_tokenizer

BLOCK_TOKENS = 1 << 16

# Fixed value: the splitting pattern of the lower-casing tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = regex.compile(r"[\x21-\x7e¡-ÿ]*")
# Latin letters followed by ASCII marks other than the apostrophe: always two pre-tokens, or one.
_LETTERS_MARKS = r"^(?P<letters>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
_CACHED_PIECES = 400_000

_FILE = pa.schema(
    [
        ("shard", pa.int32()),
        ("frame", pa.int32()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("table", pa.large_binary()),
        ("block_tokens", pa.list_(pa.int64())),
        ("block_words", pa.list_(pa.int64())),
        ("block_crc32", pa.list_(pa.int64())),
        ("states", pa.large_binary()),
        ("checkpoints", pa.large_binary()),
        ("payload", pa.large_binary()),
    ]
)
_FILE_DDL = (
    "shard int, frame int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, table binary, "
    "block_tokens array<long>, block_words array<long>, block_crc32 array<long>, states binary, "
    "checkpoints binary, payload binary"
)
_DOCS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("shard", pa.int32()),
        ("frame", pa.int32()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


class WordTokens:
    """Ids of white-space separated words, as the lower-casing tokenizer gives them for whole texts.

    Its normalizer and splitting work inside words, and no special string holds
    white space, so words can be encoded one by one, each distinct one once.
    Plain words are cut here and their pieces given to the model; all others go
    through the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self._pattern = regex.compile(WORD_PATTERN)
        self._specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self._pieces: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        """Known pieces by their number, and their packed ids."""
        self._known: dict[str, int] = {}
        self._ids, self._lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def of_word(self, word: str) -> list[int]:
        if not _PLAIN.fullmatch(word) or any(s in word for s in self._specials):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        ids: list[int] = []
        for piece in self._pattern.findall(word.lower()):
            ids += self.of_piece(piece)
        return ids

    def of_piece(self, piece: str) -> list[int]:
        known = self._pieces.get(piece)
        if known is None:
            if len(self._pieces) >= _CACHED_PIECES:
                self._pieces.clear()
            known = self._pieces[piece] = [t.id for t in self.tokenizer.model.tokenize(byte_level(piece))]
        return known

    def of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Packed ids of distinct non-empty pieces: (number per piece; ids, start and number of ids per number).

        ASCII without blanks and control characters stands for itself at byte level.
        """
        if len(self._known) >= _CACHED_PIECES:
            self._forget()
        tokenize, known = self.tokenizer.model.tokenize, self._known
        new = [p for p in pieces if p not in known]
        lists = [[t.id for t in tokenize(p if p.isascii() else byte_level(p))] for p in new]
        known.update(zip(new, range(len(known), len(known) + len(new))))
        self._lengths = np.concatenate([self._lengths, np.fromiter(map(len, lists), np.int64, len(lists))])
        self._ids = np.concatenate([self._ids, np.fromiter(chain.from_iterable(lists), np.uint32)])
        numbers = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        return numbers, self._ids, np.cumsum(self._lengths) - self._lengths, self._lengths

    def of_words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed ids of distinct words: (ids, start and number of ids per word)."""
        parts = pc.extract_regex(distinct, _LETTERS_MARKS)
        usual = np.asarray(parts.is_valid(), bool)
        odd = [self.of_word(w) for w in distinct.filter(pa.array(~usual)).to_pylist()]
        fields = parts.filter(pa.array(usual)).flatten()
        front, letters = encode_words(pc.utf8_lower(fields[0]))
        back, marks = encode_words(fields[1])
        both = [*letters.to_numpy(zero_copy_only=False).tolist(), *(w for w in marks.to_pylist() if w)]
        numbers, flat, starts, lengths = self.of_pieces(both)
        # Behind the known pieces stand the odd words, and nothing: the marks of words without any.
        more = np.array([len(x) for x in odd] + [0], np.int64)
        starts = np.concatenate([starts, len(flat) + np.cumsum(more) - more])
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(odd), np.uint32)])
        first_odd, lengths = len(lengths), np.concatenate([lengths, more])
        of_marks = np.full(len(marks), len(lengths) - 1, np.int64)
        of_marks[np.asarray(pc.greater(pc.binary_length(marks), 0), bool)] = numbers[len(letters) :]
        # A usual word is its letters and its marks, an odd one a list of its own.
        pieces = np.empty(2 * int(usual.sum()) + len(odd), np.int64)
        count = np.where(usual, 2, 1)
        first = np.cumsum(count) - count
        pieces[first[usual]] = numbers[: len(letters)][front]
        pieces[first[usual] + 1] = of_marks[back]
        pieces[first[~usual]] = first_odd + np.arange(len(odd))
        ids = flat[expand(pieces, starts, lengths)]
        n = np.bincount(np.repeat(np.arange(len(usual)), count), lengths[pieces], len(usual)).astype(np.int64)
        return ids, np.cumsum(n) - n, n

    def of_texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with ``end_id`` after each text, and the number of ids per text."""
        words, per_text = split_words(texts)
        codes, distinct = encode_words(words)
        flat, starts, lengths = self.of_words(distinct)
        owner = np.repeat(np.arange(len(texts)), per_text)
        n = np.bincount(owner, lengths[codes] if len(codes) else None, len(texts)).astype(np.int64) + 1
        ids = np.full(int(n.sum()), end_id, np.uint32)
        body = np.ones(len(ids), bool)
        body[np.cumsum(n) - 1] = False
        ids[body] = flat[expand(codes, starts, lengths)]
        return ids, n


@functools.lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One encoder per worker process, so that later tasks find known pieces."""
    return WordTokens(path)


def write_token_file(
    docs: DataFrame, target: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of all texts to ``target``, ``end_id`` after each.

    A NULL text is an empty one (its end id only).  NULL ids come first.  Rows
    with the same id follow each other by text; repeated rows are all written.
    Only ``doc_id`` and ``text`` are read.  An empty table makes a file without
    frames.
    """

    @giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard, frame_number = word_tokens(path), TaskContext.get().partitionId(), 0
        for part in slices(batches, "text"):
            ids, n = tokens.of_texts(large_texts(part.column("text")), end_id)
            blocks = (np.cumsum(n) - n) // BLOCK_TOKENS
            bounds = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist()]
            frame = rans.encode(ids, np.add.reduceat(n, bounds).tolist())
            row = {
                "shard": shard,
                "frame": frame_number,
                "n_tokens": len(ids),
                "doc_ids": part.column("id").to_pylist(),
                "doc_tokens": n.tolist(),
                "table": frame.table,
                "block_tokens": [b[0] for b in frame.blocks],
                "block_words": [b[1] for b in frame.blocks],
                "block_crc32": [b[2] for b in frame.blocks],
                "states": frame.states,
                "checkpoints": frame.checkpoints,
                "payload": frame.payload,
            }
            frame_number += 1
            yield pa.RecordBatch.from_pylist([row], schema=_FILE)

    (
        docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("id", "_tie")
        .sortWithinPartitions("id", "_tie", "text")
        .select("id", "text")
        .mapInArrow(encode, _FILE_DDL)
        .write.parquet(target)
    )


def frame_ids(row: dict) -> np.ndarray:
    """The ids of one frame of the file."""
    blocks = list(zip(row["block_tokens"], row["block_words"], row["block_crc32"]))
    return rans.decode(rans.Frame(row["table"], blocks, row["states"], row["checkpoints"], row["payload"]))


def read_token_file(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the ids in the file.

    ``start`` counts the ids of all documents before it.  Checksums are verified.
    """

    @giving_back
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, n = frame_ids(row), np.array(row["doc_tokens"], np.int64)
                before = np.cumsum(n) - n
                crc = [rans.crc_of(ids[a : a + k]) for a, k in zip(before.tolist(), n.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": row["doc_ids"],
                        "shard": [row["shard"]] * len(n),
                        "frame": [row["frame"]] * len(n),
                        "before": before,
                        "n_tokens": n,
                        "ids_crc32": crc,
                    },
                    schema=_DOCS,
                )

    file = spark.read.schema(_FILE_DDL).parquet(target)
    # One row per shard, then one per frame: a few rows for millions of ids.
    shards = file.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before_shard = shards.select(
        "shard",
        F.coalesce(
            F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("shard_start"),
    )
    inside = Window.partitionBy("shard").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    frames = (
        file.select("shard", "frame", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("frame_start"))
        .join(before_shard, "shard")
        .select("shard", "frame", (F.col("shard_start") + F.col("frame_start")).alias("frame_start"))
    )
    docs = file.mapInArrow(
        decode, "doc_id long, shard int, frame int, before long, n_tokens long, ids_crc32 long"
    )
    return docs.join(frames, ["shard", "frame"]).select(
        "doc_id", (F.col("frame_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
