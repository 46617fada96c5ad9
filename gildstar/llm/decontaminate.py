"""Benchmark passages in documents by CGK embedding and bit sampling (operator 5).

A CGK random walk reads a text and writes a string on which edit distance becomes
Hamming distance: step j writes the character it stands on and moves on or stays,
as a random bit of (j, character) says.  Walks with ``SAMPLES`` sampled steps each
give the keys of a window.  As only early steps are sampled, the keys of all
item-sized windows that start at one word are the same, and a walk is followed no
further than its last sampled step.

Windows start at every ``STRIDE``-th word of a document and at each word of an item
from which the walk stays within it.  A short item has few windows, so it takes more
of the ``REPETITIONS`` walks: as many as give it ``TRIALS`` keys.  Items of fewer than
``EXACT_BELOW`` characters are found without loss: of one more piece than edits are
allowed, one must stand unchanged.  Where keys or pieces meet, the ``_CHUNK``
characters of the item around the place are compared first, all places at once;
what is left is checked by the exact edit distance of the item to the best stretch
around the place.  Items are taken in blocks of bounded size, each block against all
documents in one pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.llm.common import giving_back, large_texts, mix64, slices

STEPS = 24
SAMPLES = 11
REPETITIONS = 6
TRIALS = 120  # keys an item should have: windows times walks
STRIDE = 1
MOST_EDITS = 0.25  # of the item's characters
BLOCK_CHARS = 4 << 20  # characters of items held at a time
EXACT_BELOW = 64  # characters; shorter items are found by unchanged pieces
_CHUNK = 64  # characters compared first, as many as a word has bits
_SLACK = _CHUNK // 4  # how far these may be shifted by edits before them
_SPARE = 4  # edits a chunk of a longer item may have beyond its share
_AT_ONCE = 1 << 13  # places compared or walked from at one time, so that working arrays stay in the processor's cache
_SEPARATOR = "\n"

_BITS = (
    mix64(np.arange(REPETITIONS * STEPS * 256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5))
    & np.uint64(1)
).astype(np.int64).reshape(REPETITIONS, STEPS, 256)
_SAMPLED = [
    sorted(np.argsort(mix64(np.arange(STEPS, dtype=np.uint64) + np.uint64(1000 * (z + 1))))[:SAMPLES].tolist())
    for z in range(REPETITIONS)
]


def normalise(texts: pa.Array) -> pa.Array:
    """Lower case, words of letters and digits with one space between."""
    folded = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " ")
    return pc.utf8_trim(folded, " ")


def letters(text: str) -> np.ndarray:
    """One byte per character, with room for walks that run over the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate([((points ^ (points >> 8)) & 255).astype(np.uint8), np.zeros(STEPS + 1, np.uint8)])


def word_starts(text: np.ndarray) -> np.ndarray:
    """Places where a word begins (after a space, a separator or the beginning)."""
    gap = (text == ord(" ")) | (text == ord(_SEPARATOR)) | (text == 0)
    return np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))


def walk(text: np.ndarray, places: np.ndarray, repetition: int) -> tuple[np.ndarray, np.ndarray]:
    """The sampled characters of the walk from each place, as a hash, and where the walk ends."""
    ends, keys = places.astype(np.int64), np.full(len(places), repetition + 1, np.uint64)
    sampled = _SAMPLED[repetition]
    for k in range(0, len(places), _AT_ONCE):
        at, key = ends[k : k + _AT_ONCE], keys[k : k + _AT_ONCE]
        here, move = np.empty(len(at), np.uint8), np.empty(len(at), np.int64)
        for step in range(sampled[-1] + 1):
            np.take(text, at, out=here, mode="clip")
            if step in sampled:
                key *= np.uint64(0x100000001B3)
                key += here
            if step < sampled[-1]:
                at += np.take(_BITS[repetition, step], here, out=move, mode="clip")
    return mix64(keys), ends


def expand(left: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The positions left, left + 1, .. of ``n`` each, one list after the other."""
    return np.repeat(left - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Items:
    """A block of items: their normalised texts, the keys of their windows in order, the pieces of short ones."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids, self.texts = ids, texts
        self.lengths = np.array([len(t) for t in texts], np.int64)
        keys, item, offset = [], [], []
        self.words: ahocorasick.Automaton | None = None
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, t in enumerate(texts):
            most = int(len(t) * MOST_EDITS)
            if not most:
                self.words = self.words or ahocorasick.Automaton()
                self.words.get(f" {t} ", None) or self.words.add_word(f" {t} ", [])
                self.words.get(f" {t} ").append(number)
                continue
            if len(t) < EXACT_BELOW:
                cuts = [len(t) * i // (most + 1) for i in range(most + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    pieces[t[a:b]].append((number, a))
                continue
            coded = letters(t)
            starts = word_starts(coded)
            tried = 0
            for z in range(REPETITIONS):
                if tried >= TRIALS:
                    break
                key, end = walk(coded, starts, z)
                within = end < len(t)
                keys.append(key[within])
                item.append(np.full(int(within.sum()), number))
                offset.append(starts[within])
                tried += len(keys[-1])
        if self.words:
            self.words.make_automaton()
        self.pieces: ahocorasick.Automaton | None = None
        if pieces:
            self.pieces = ahocorasick.Automaton()
            for number, piece in enumerate(pieces):
                self.pieces.add_word(piece, number)
            self.pieces.make_automaton()
        sizes = np.array([len(v) for v in pieces.values()], np.int64)
        self.piece_first, self.piece_count = np.cumsum(sizes) - sizes, sizes
        self.piece_chars = np.array([len(p) for p in pieces], np.int64)
        self.piece_of = np.array([x for v in pieces.values() for x in v], np.int64).reshape(-1, 2)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.item = np.concatenate(item)[order] if item else np.zeros(0, np.int64)
        self.offset = np.concatenate(offset)[order] if offset else np.zeros(0, np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True

    def candidates(self, joined: str, text: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (item number, place where the item would start) whose chunk is near enough."""
        found: list[np.ndarray] = []
        for z in range(REPETITIONS if len(self.keys) else 0):
            keys, _ = walk(text, places, z)
            likely = np.flatnonzero(self.maybe[keys >> np.uint64(44)])
            keys = keys[likely]
            left, right = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
            hit = expand(left, right - left)
            at = np.repeat(places[likely], right - left)
            found.append(self.near(text, self.item[hit], self.offset[hit], at))
        if self.pieces:
            hits = np.array(list(self.pieces.iter(joined)), np.int64).reshape(-1, 2)
            n = self.piece_count[hits[:, 1]]
            item, offset = self.piece_of[expand(self.piece_first[hits[:, 1]], n)].T
            at = np.repeat(hits[:, 0] + 1 - self.piece_chars[hits[:, 1]], n)
            found.append(self.near(text, item, offset, at))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def near(self, text: np.ndarray, item: np.ndarray, offset: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distinct rows (item, start) of the items whose ``offset`` meets the text ``at`` a place, if the chunk around it agrees."""
        # Chunks begin at every half chunk; the offset lies in the first half of its chunk, or in the last chunk.
        half = _CHUNK // 2
        spread = np.maximum(0, self.lengths - _CHUNK)
        counts = -(-spread // half) + 1
        base = np.cumsum(counts) - counts
        shift = int(self.lengths.max(initial=0))
        width = len(text) + shift
        rows = np.sort((base[item] + np.minimum(offset // half, counts[item] - 1)) * width + at - offset + shift)
        rows = rows[np.concatenate([[True], rows[1:] != rows[:-1]])] if len(rows) else rows
        padded = np.concatenate([np.zeros(_CHUNK * 2, np.uint8), text, np.zeros(_CHUNK * 2, np.uint8)])
        kept = [np.zeros((0, 2), np.int64)]
        for k in range(0, len(rows), _AT_ONCE):
            chunk, begin = rows[k : k + _AT_ONCE] // width, rows[k : k + _AT_ONCE] % width - shift
            chunks, which = np.unique(chunk, return_inverse=True)
            owner = np.searchsorted(base, chunks, "right") - 1
            first = np.minimum((chunks - base[owner]) * half, spread[owner])
            sizes = np.minimum(self.lengths[owner], _CHUNK)
            masks = np.zeros((len(chunks), 256), np.uint64)
            for mask, i, f in zip(masks, owner.tolist(), first.tolist()):
                code = letters(self.texts[i][f : f + _CHUNK])[: -(STEPS + 1)]
                np.bitwise_or.at(mask, code, np.uint64(1) << np.arange(len(code), dtype=np.uint64))
            start = np.clip(begin + first[which] - _SLACK + 2 * _CHUNK, 0, len(padded) - 1)
            best = chunk_distances(masks, sizes, which, padded, start)
            # A short item is its own chunk and keeps to its edits; a longer one may have more of them here than elsewhere.
            most = (sizes * MOST_EDITS).astype(np.int64) + np.where(spread[owner] > 0, _SPARE, 0)
            near = best <= most[which]
            kept.append(np.stack([owner[which][near], begin[near]], 1))
        return np.concatenate(kept)


def chunk_distances(masks: np.ndarray, sizes: np.ndarray, which: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per place the least edit distance of its chunk to any stretch from ``start`` on (bit-parallel, all places together)."""
    if not len(which):
        return np.zeros(0, np.int64)
    one, top = np.uint64(1), np.uint64(63)
    # Chunks end at the highest bit; the bits below a short chunk match everything, which costs nothing.
    spare = (_CHUNK - sizes).astype(np.uint64)
    below = (one << spare) - one
    flat = ((masks << spare[:, None]) | below[:, None]).reshape(-1)
    base = which * 256
    pv, mv = ~below[which], np.zeros(len(which), np.uint64)
    score = sizes[which].astype(np.int64)
    best = score.copy()
    steps = int(sizes.max(initial=0)) + 2 * _SLACK
    padded = np.concatenate([text, np.full(steps, text[-1], np.uint8)])
    columns = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, steps)[start].T)
    at = np.empty(len(which), np.int64)
    eq, xv, xh, ph, mh = (np.empty(len(which), np.uint64) for _ in range(5))
    for column in columns:
        np.take(flat, np.add(base, column, out=at), out=eq, mode="clip")
        np.bitwise_or(eq, mv, out=xv)
        np.bitwise_and(eq, pv, out=xh)
        xh += pv
        xh ^= pv
        xh |= eq
        np.bitwise_or(xh, pv, out=ph)
        np.invert(ph, out=ph)
        ph |= mv
        np.bitwise_and(pv, xh, out=mh)
        score += np.right_shift(ph, top, out=eq).view(np.int64)
        score -= np.right_shift(mh, top, out=eq).view(np.int64)
        ph <<= one
        mh <<= one
        np.bitwise_or(xv, ph, out=pv)
        np.invert(pv, out=pv)
        pv |= mh
        np.bitwise_and(ph, xv, out=mv)
        np.minimum(best, score, out=best)
    return best


def best_distance(item: str, text: str, most: int) -> int | None:
    """The least edit distance of ``item`` to any stretch of ``text``, None if above ``most`` (bit-parallel)."""
    m = len(item)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        peq[c] |= 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        best = min(best, score)
    return best if best <= most else None


def leaks_of(texts: pa.Array, items: Items) -> list[list[tuple[int, int]]]:
    """Per text the (item number, edit distance) of every item found in it."""
    plain = normalise(texts).to_pylist()
    joined = _SEPARATOR.join(plain)
    coded = letters(joined)
    ends = np.cumsum([len(t) + 1 for t in plain])
    starts = word_starts(coded)
    owner = np.searchsorted(ends, starts, side="right")
    in_text = np.arange(len(starts)) - np.searchsorted(owner, owner, side="left")
    used = in_text % STRIDE == 0
    places, owner = starts[used], owner[used]
    found: list[dict[int, int]] = [{} for _ in plain]
    if items.words:
        for text, here in zip(plain, found):
            here |= {number: 0 for _, numbers in items.words.iter(f" {text} ") for number in numbers}
    if not len(places) or not (len(items.keys) or items.pieces):
        return [sorted(f.items()) for f in found]
    numbers, at = items.candidates(joined, coded, places)
    # The hit lies in the text that holds the matched window, not where the item would start.
    checked: set[tuple[int, int, int]] = set()
    for number, place in zip(numbers.tolist(), at.tolist()):
        item = items.texts[number]
        most = int(len(item) * MOST_EDITS)
        for text_number in {
            int(np.searchsorted(ends, min(max(0, p), len(joined)), side="right"))
            for p in (place, place + len(item) // 2, place + len(item) - 1)
        }:
            if text_number >= len(plain):
                continue
            text = plain[text_number]
            start = place - int(ends[text_number]) + len(text) + 1
            mark = (text_number, number, start // max(1, most))
            if mark in checked or found[text_number].get(number) == 0:
                continue
            checked.add(mark)
            a, b = max(0, start - 2 * most), min(len(text), start + len(item) + 2 * most)
            stretch = text[a:b]
            distance = best_distance(item, stretch, most)
            if distance is not None:
                found[text_number][number] = min(distance, found[text_number].get(number, distance))
    return [sorted(f.items()) for f in found]


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Blocks of (ids, normalised texts) of at most BLOCK_CHARS characters (or one item); items without words are left out."""
    ids: list = []
    texts: list[str] = []
    size = 0
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.coalesce(text, F.lit("")).alias("t"))
    for row in rows.orderBy("i", "t").toLocalIterator():
        plain = normalise(pa.array([row["t"]], pa.large_string()))[0].as_py()
        if not plain:
            continue
        if ids and size + len(plain) > BLOCK_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(plain)
        size += len(plain)
    if ids:
        yield ids, texts


def mark_leaks(
    docs: DataFrame, items: DataFrame, column: str = "leaks", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with an array of (item_id, distance, chars): the items each row contains.

    An item is contained if some stretch of the row's text is within
    ``MOST_EDITS`` of the item's length, both normalised.  Items below
    ``EXACT_BELOW`` characters are found always, longer ones by chance, most often
    at the recall the README gives.  Items too short for a single edit count only
    where their words stand unchanged.  NULL and empty texts
    and items contain nothing; repeated items are all reported; all rows and
    columns are kept, and ``column`` must not be among them.
    """
    if column in docs.columns:
        raise ValueError(f"column {column!r} exists")
    kind = T.ArrayType(
        T.StructType(
            [T.StructField("item_id", T.LongType()), T.StructField("distance", T.LongType()), T.StructField("chars", T.LongType())]
        )
    )
    arrow_kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64()), ("chars", pa.int64())]))
    spark, names = docs.sparkSession, docs.columns
    marked = docs.withColumn(column, F.array().cast(kind))
    for ids, texts in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(Items(ids, texts))

        @giving_back
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for part in slices(batches, text):
                before = part.column(column).to_pylist()
                found = [
                    old + [{"item_id": block.ids[n], "distance": d, "chars": len(block.texts[n])} for n, d in new]
                    for old, new in zip(before, leaks_of(large_texts(part.column(text)), block))
                ]
                columns = [part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, arrow_kind)], names=[*names, column])

        marked = marked.mapInArrow(run, marked.schema)
    return marked


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, chars): every item each row contains, by its least edit distance.

    Rows with NULL ids are reported with a NULL id, repeated rows repeatedly.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return (
        mark_leaks(narrow, items)
        .select(F.col("doc_id").alias(doc_id), F.explode("leaks").alias("x"))
        .select(doc_id, "x.*")
    )
