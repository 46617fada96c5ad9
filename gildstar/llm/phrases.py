"""Phrase collocations by prefix-free parsing (operator 12).

Texts are cut at punctuation into pieces of words.  A piece is parsed into
chunks: a window of three words whose hash is divisible by ``TRIGGER`` ends one
chunk and begins the next, so neighbours overlap by these three words and equal
passages give equal chunks wherever they stand.  The distinct chunks with their
frequencies are the dictionary; n-grams are counted inside it, weighted.  An
n-gram belongs to the chunk in which it starts outside the closing overlap,
which the next chunk opens with, so each occurrence counts once.

Only n-grams whose words and neighbouring pairs all occur ``min_count`` times
can do so themselves.  Words and pairs are counted first by 64-bit fingerprint;
the frequent ones fill a filter of fixed size that goes to the tasks.  The
filter never loses a frequent n-gram: fingerprints or bits that collide, or a
filter that fills up, only let more n-grams through to the exact count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gildstar.llm.common import encode_words, expand, gathered, large_texts, mix64
from gildstar.session import run_folder

MAX_WORDS = 4
OVERLAP = MAX_WORDS - 1
TRIGGER = 16
MIN_COUNT = 30
COVERED_PERCENT = 80
TOP = 2000
# Bits of the filter: 8 MB, about one false pass in twenty at four million frequent words and pairs.
FILTER_BITS = 1 << 26

# What ends a piece, what parts words, what is lower-cased.
_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_CHUNKS = pa.schema([("lang", pa.large_string()), ("chunk", pa.large_string()), ("last", pa.bool_()), ("freq", pa.int64())])
_PRINTS = pa.schema([("fp", pa.int64()), ("freq", pa.int64())])
_GRAMS = pa.schema(
    [("lang", pa.large_string()), ("words", pa.int32()), ("phrase", pa.large_string()), ("freq", pa.int64())]
)


def _large(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2])


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large string array that starts at its buffer's first byte."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8, offsets[-1]) if data else np.zeros(0, np.uint8)), offsets


class Words:
    """The words of some texts in order: dictionary codes, owner text and piece number."""

    def __init__(self, texts: pa.Array):
        raw, offsets = _bytes_of(texts)
        kind = _KIND[raw]
        inside = kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        # A text begins and ends its words, whatever stands beside it in the buffer.
        filled = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads] |= inside[heads]
        last[tails] |= inside[tails]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.data = _LOWER[raw[inside]]
        self.lengths = ends - starts
        self.text = np.searchsorted(offsets, starts, side="right") - 1
        breaks = np.cumsum(kind == 2)
        self.piece = (breaks[starts] if len(starts) else starts) + self.text
        bounds = np.concatenate([[0], np.cumsum(self.lengths)])
        self.codes, self.known = encode_words(_large(self.data, bounds))
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.known.to_pylist()], np.uint64)
        self.hash = hashes[self.codes] if len(hashes) else np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.codes)

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words each followed by a space, and where each begins."""
        n, bounds = len(self), np.concatenate([[0], np.cumsum(self.lengths + 1)])
        out = np.full(bounds[-1], 32, np.uint8)
        out[np.arange(len(self.data)) + np.repeat(np.arange(n), self.lengths)] = self.data
        return out, bounds


def parse(words: Words, trigger: int = TRIGGER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks as (first word, end, last of its piece): half-open ranges of word positions.

    The window that opens a piece ends no chunk, as no n-gram would start in it.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    piece, h = words.piece, words.hash
    closes = np.ones(n, bool)
    closes[:-1] = piece[1:] != piece[:-1]
    cut = np.zeros(n, bool)
    if n > OVERLAP:
        window = mix64(h[2:] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[:-2] * np.uint64(7))
        cut[OVERLAP:] = (window[1:] % np.uint64(trigger) == 0) & (piece[OVERLAP:] == piece[:-OVERLAP])
    cut &= ~closes
    ends = np.flatnonzero(cut | closes) + 1
    last = closes[ends - 1]
    begins = np.concatenate([[0], np.where(last[:-1], ends[:-1], ends[:-1] - OVERLAP)])
    return begins, ends, last


def chunk_dictionary(docs: DataFrame, lang: str = "lang", text: str = "text", trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, last, freq): the distinct chunks of every language; a NULL language is ``und``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "text"):
            words = Words(large_texts(part.column("text")))
            begins, ends, last = parse(words, trigger)
            if not len(begins):
                continue
            data, bounds = words.spaced()
            lengths = bounds[ends] - 1 - bounds[begins]
            chosen = data[expand(np.arange(len(begins)), bounds[begins], lengths)]
            chunks = _large(chosen, np.concatenate([[0], np.cumsum(lengths)]))
            langs = part.column("lang").cast(pa.large_string()).take(pa.array(words.text[begins]))
            table = pa.table({"lang": langs, "chunk": chunks, "last": pa.array(last)})
            counted = table.group_by(["lang", "chunk", "last"]).aggregate([([], "count_all")])
            counted = counted.rename_columns({"count_all": "freq"}).select(_CHUNKS.names)
            yield from counted.cast(_CHUNKS).combine_chunks().to_batches()

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    parts = rows.mapInArrow(cut, "lang string, chunk string, last boolean, freq long")
    return parts.groupBy("lang", "chunk", "last").agg(F.sum("freq").alias("freq"))


class _Positions:
    """Word positions of some chunks: language, weight, how many words follow, and whether n-grams start here."""

    def __init__(self, part: pa.RecordBatch):
        self.words = Words(large_texts(part.column("chunk")))
        owner = self.words.text
        self.langs = part.column("lang").cast(pa.large_string()).dictionary_encode()
        codes = self.langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.lang = codes[owner]
        names = self.langs.dictionary.to_pylist()
        self.lang_hash = np.array([xxhash.xxh64_intdigest(x, 12) for x in names], np.uint64)
        self.weight = part.column("freq").to_numpy(zero_copy_only=False)[owner]
        end = np.cumsum(np.bincount(owner, minlength=part.num_rows))[owner]
        self.after = end - np.arange(len(owner))  # words from here to the chunk's end, this one included
        last = np.asarray(part.column("last"))[owner]
        self.starts = last | (self.after > OVERLAP)

    def prints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints of the word and of the pair at each position, and where a pair stands."""
        salt, h = self.lang_hash[self.lang], self.words.hash
        one = mix64(h + salt)
        two = np.zeros(len(h), np.uint64)
        pair = self.after >= 2
        at = np.flatnonzero(pair)
        two[at] = mix64(mix64(h[at] * np.uint64(0x9E3779B97F4A7C15) + h[at + 1]) ^ salt[at])
        return one, two, pair


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a position of each, and the sum of its weights."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    return ordered[at], order[at], np.add.reduceat(weights[order], at) if len(at) else weights[:0]


def _probes(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (fp & mask).astype(np.int64), ((fp >> np.uint64(32)) & mask).astype(np.int64)


def _frequent_filter(dictionary: DataFrame, min_count: int, bits: int) -> np.ndarray:
    """The filter's 64-bit words: two bits for each word and pair that occurs ``min_count`` times in its language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "chunk"):
            p = _Positions(part)
            one, two, pair = p.prints()
            keys = np.concatenate([one[p.starts], two[p.starts & pair]])
            weights = np.concatenate([p.weight[p.starts], p.weight[p.starts & pair]])
            fp, _, freq = _summed(keys, weights)
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(freq)], schema=_PRINTS)

    low = F.col("fp").bitwiseAND(bits - 1)
    high = F.shiftrightunsigned("fp", 32).bitwiseAND(bits - 1)
    set_bits = (
        dictionary.select("lang", "chunk", "last", "freq")
        .mapInArrow(count, "fp long, freq long")
        .groupBy("fp")
        .agg(F.sum("freq").alias("freq"))
        .filter(F.col("freq") >= min_count)
        .select(F.explode(F.array(low, high)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word"))
        .toArrow()
    )
    words = np.zeros(bits >> 6, np.int64)
    words[set_bits.column("at").to_numpy()] = set_bits.column("word").to_numpy()
    return words.view(np.uint64)


def phrase_counts(dictionary: DataFrame, min_count: int = MIN_COUNT, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, words, phrase, freq): all n-grams of one to four words that occur ``min_count`` times, exactly counted."""
    spark = dictionary.sparkSession
    shared = spark.sparkContext.broadcast(_frequent_filter(dictionary, min_count, bits))

    def passes(fp: np.ndarray) -> np.ndarray:
        words, out = shared.value, np.ones(len(fp), bool)
        for bit in _probes(fp, bits):
            out &= (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "chunk"):
            p = _Positions(part)
            one, two, pair = p.prints()
            pair &= passes(two)
            codes, size = p.words.codes, max(1, len(p.words.known))
            # An n-gram's key is exact: number of its first n - 1 words times the dictionary's size, plus its last word.
            at = np.flatnonzero(p.starts & passes(one))
            keys, grown = p.lang[at] * size + codes[at], at
            names = [p.langs.dictionary]
            for n in range(1, MAX_WORDS + 1):
                _, where, freq = _summed(keys, p.weight[at])
                place = at[where]
                langs = names[0].take(pa.array(p.lang[place]))
                parts = [p.words.known.take(pa.array(codes[place + i])) for i in range(n)]
                phrases = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if n > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(np.full(len(place), n, np.int32)), phrases, pa.array(freq)],
                    schema=_GRAMS,
                )
                if n == MAX_WORDS:
                    break
                # Pairs start from every counted position, longer ones from those whose pairs are all frequent.
                grown = np.flatnonzero(p.starts & pair) if n == 1 else at[pair[at + n - 1] & (p.after[at] > n)]
                prefix = p.lang[grown] * size + codes[grown] if n == 1 else keys[pair[at + n - 1] & (p.after[at] > n)]
                number = np.unique(prefix, return_inverse=True)[1]
                keys, at = number * size + codes[grown + n], grown

    return (
        dictionary.select("lang", "chunk", "last", "freq")
        .mapInArrow(count, "lang string, words int, phrase string, freq long")
        .groupBy("lang", "words", "phrase")
        .agg(F.sum("freq").alias("freq"))
        .filter(F.col("freq") >= min_count)
    )


def _exact(column: str) -> str:
    return f"cast({column} as decimal(38, 0))"


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    covered_percent: int = COVERED_PERCENT,
    top: int | None = TOP,
    lang: str = "lang",
    text: str = "text",
    trigger: int = TRIGGER,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to four words in each language.

    a, l and r count the phrase and the two parts of its lowest-scoring cut (ties:
    the shortest first part), n all words of the language, score is
    floor(2000000 a / (l + r)).  A phrase that lies in a longer one with at least
    ``covered_percent`` of its count is left out.  Rank goes by score, then a,
    then the phrase's bytes; ``top`` None returns all.

    A NULL language is ``und``; NULL and empty texts hold no words; repeated rows
    count each time, whatever their ids; equal texts are parsed alike; an empty
    table gives no rows.  Only the language and the text are read, so other
    columns cannot clash.  Sums and products are exact: counts are 64-bit, their
    products decimals of 38 digits.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "phrases")
    chunk_dictionary(docs, lang, text, trigger).write.parquet(f"{folder}/chunks")
    dictionary = spark.read.schema("lang string, chunk string, last boolean, freq long").parquet(f"{folder}/chunks")
    phrase_counts(dictionary, min_count, bits).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("lang string, words int, phrase string, freq long").parquet(f"{folder}/counts")

    length = F.size(F.split("chunk", " "))
    starting = F.when(F.col("last"), length).otherwise(length - OVERLAP)
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("freq") * starting).alias("n"))
    return rank_phrases(counts, totals, covered_percent, top)


def rank_phrases(counts: DataFrame, totals: DataFrame, covered_percent: int, top: int | None) -> DataFrame:
    """Score, thin out and rank counted phrases (lang, words, phrase, freq); ``totals`` holds (lang, n).

    ``counts`` must hold every part of its phrases.
    """
    several = counts.filter("words > 1").select("lang", "words", "phrase", F.col("freq").alias("a"), F.split("phrase", " ").alias("w"))
    left, right = (counts.select("lang", F.col("phrase").alias(p), F.col("freq").alias(c)) for p, c in (("first", "l"), ("rest", "r")))
    cut = several.select("lang", "words", "phrase", "a", "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cut = cut.withColumns({"first": F.expr("array_join(slice(w, 1, k), ' ')"), "rest": F.expr("array_join(slice(w, k + 1, words - k), ' ')")})
    score = F.expr(f"cast(({_exact('2000000')} * {_exact('a')}) div ({_exact('l')} + {_exact('r')}) as bigint)")
    scored = (
        cut.drop("w")
        .join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "words", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    inner = several.filter("words > 2").select(
        "lang",
        "a",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, words - 1), m -> "
                "transform(sequence(1, words - m + 1), s -> array_join(slice(w, s, m), ' '))))"
            )
        ).alias("phrase"),
    )
    covers = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = F.expr(f"longer is null or 100 * {_exact('longer')} < {covered_percent} * {_exact('a')}")
    kept = scored.join(covers, ["lang", "phrase"], "left").filter(free).select("lang", "phrase", "a", "best.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
