"""Spelling variants: words one edit apart, found by scanning sorted lists (operator 13).

The edit between two such words lies in one of ``PARTS`` parts of the shorter
one; before and behind that part they agree.  The vocabulary is dealt into
ranges that share what stands before and behind a part, and a range is a sorted
list of what its words have in the part (common ends do not change an edit
distance).  Each word is compared with its range's list by dynamic programming:
rows of the edit matrix, three cells wide, belong to prefixes of the list's
entries, so an entry goes on from the rows of the prefix that it shares with the
one before (their longest common prefix), and once every cell of a row exceeds
one edit the scan leaps over all entries that share that prefix.

A range of more than ``SCANNERS`` words is scanned in several shares, each by a
part of its words.  A pair that several ranges hold belongs to the first part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.llm.common import gathered, large_texts
from gildstar.session import run_folder

MIN_CHARS = 6
MIN_COUNT = 5
# One run in so many loses a code point; how many times as frequent a word's form is.
MODULUS, FACTOR = 199, 5
PARTS = 3
# Words of a range that one share scans with.
SCANNERS = 5_000

_COUNTED = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
_PAIRS = pa.schema([("word", pa.large_string()), ("n", pa.int64()), ("near", pa.large_string()), ("near_n", pa.int64())])


# --- words -------------------------------------------------------------------


def _crc_tables() -> np.ndarray:
    """Four tables that carry a crc32 over one zero byte, indexed by the crc's bytes."""
    single = np.array([zlib.crc32(b"\0", c) ^ zlib.crc32(b"\0", 0) for c in (1 << np.arange(32)).tolist()], np.uint32)
    tables = np.zeros((4, 256), np.uint32)
    for part in range(4):
        for bit in range(8):
            on = (np.arange(256) >> bit) & 1 == 1
            tables[part][on] ^= single[8 * part + bit]
    return tables


def crc_after(prefix: np.ndarray, lengths: np.ndarray, word_crc: np.ndarray) -> np.ndarray:
    """crc32 of prefix + word from the crc32 of each and the word's length in bytes.

    crc32(prefix + word) = Z^length(crc32(prefix)) ^ crc32(word), Z carrying a
    crc over one zero byte.
    """
    tables, state = _crc_tables(), prefix.astype(np.uint32).copy()
    left, active = lengths.copy(), np.flatnonzero(lengths > 0)
    while len(active):
        s = state[active]
        state[active] = tables[0][s & 255] ^ tables[1][(s >> 8) & 255] ^ tables[2][(s >> 16) & 255] ^ tables[3][s >> 24]
        left[active] -= 1
        active = active[left[active] > 0]
    return state ^ word_crc.astype(np.uint32)


_RUN_BYTES = np.zeros(256, np.uint8)
_RUN_BYTES[list(range(65, 91)) + list(range(97, 123))] = 1


def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased (A-Z only) letter runs of all texts in order, and how many each text has."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8, offsets[-1]) if data else np.zeros(0, np.uint8)
    inside = _RUN_BYTES[raw] == 1
    # U+00C0 to U+00FF are the byte 0xC3 and any continuation byte.
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) else np.zeros(0, np.int64)
    inside[lead] = inside[lead + 1] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] |= inside[heads]
    last[tails] |= inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    chosen = raw[inside].copy()
    upper = (chosen >= 65) & (chosen <= 90)
    chosen[upper] += 32
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(chosen))
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return runs, counts


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words after the deletions, at least ``MIN_CHARS`` long and ``MIN_COUNT`` times found."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "text"):
            runs, counts = letter_runs(large_texts(part.column("text")))
            encoded = runs.dictionary_encode()
            known, codes = encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False)
            if not known:
                continue
            prefixes = np.array([zlib.crc32(f"{i}:".encode()) for i in part.column("id").to_pylist()], np.uint32)
            crcs = np.array([zlib.crc32(w.encode()) for w in known], np.uint32)
            sizes = pc.binary_length(encoded.dictionary).to_numpy().astype(np.int64)
            codes = codes.astype(np.int64)
            h = crc_after(np.repeat(prefixes, counts), sizes[codes], crcs[codes])
            cut = h % MODULUS == 0
            whole = np.bincount(codes[~cut], minlength=len(known))
            shorter: dict[str, int] = {}
            for code, value in zip(codes[cut].tolist(), h[cut].tolist()):
                at = value % len(known[code])
                word = known[code][:at] + known[code][at + 1 :]
                shorter[word] = shorter.get(word, 0) + 1
            words = pa.concat_arrays([encoded.dictionary, pa.array(list(shorter), pa.large_string())])
            freq = np.concatenate([whole, np.array(list(shorter.values()), np.int64)]).astype(np.int64)
            long_ones = np.asarray(pc.utf8_length(words)) >= MIN_CHARS
            keep = pa.array(long_ones & (freq > 0))
            yield pa.RecordBatch.from_arrays([words.filter(keep), pa.array(freq).filter(keep)], schema=_COUNTED)

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# --- scanning a sorted list ----------------------------------------------------


class SortedList:
    """Strings in code-point order, with what a scan needs to go on from shared prefixes and to leap.

    ``lcp[i]`` is the length of the common prefix of entry i and the one before;
    ``lower[i]`` the next entry whose ``lcp`` is smaller.
    """

    def __init__(self, entries: list[str]):
        self.entries, count = entries, len(entries)
        self.lcp, self.lower = [0] * count, [count] * count
        for i in range(1, count):
            a, b = entries[i - 1], entries[i]
            k, most = 0, min(len(a), len(b))
            while k < most and a[k] == b[k]:
                k += 1
            self.lcp[i] = k
        stack: list[int] = []
        for i, k in enumerate(self.lcp):
            while stack and self.lcp[stack[-1]] > k:
                self.lower[stack.pop()] = i
            stack.append(i)

    def near(self, word: str) -> list[int]:
        """Positions of the entries exactly one edit from ``word``.

        Row d holds the edits between an entry's first d characters and the first
        d - 1, d and d + 1 characters of ``word``; 2 stands for more than one.
        """
        entries, lcp, lower, size, out = self.entries, self.lcp, self.lower, len(word), []
        rows = [(2, 0, 1 if size else 2)]
        i, depth, count = 0, 0, len(entries)
        while i < count:
            entry = entries[i]
            dead = 0
            for d in range(depth + 1, len(entry) + 1):
                c = entry[d - 1]
                low, mid, high = rows[d - 1]
                a = low if 2 <= d <= size + 1 and word[d - 2] == c else 1 + (low if low < mid else mid)
                b = e = 2
                if d <= size:
                    b = mid if word[d - 1] == c else 1 + min(mid, high, a)
                    if d < size:
                        e = high if word[d] == c else 1 + (high if high < b else b)
                if a > 1 and b > 1 and e > 1:
                    dead = d
                    break
                row = (a if a < 2 else 2, b if b < 2 else 2, e if e < 2 else 2)
                if d < len(rows):
                    rows[d] = row
                else:
                    rows.append(row)
            if dead:
                depth = dead - 1
                i += 1
                while i < count and lcp[i] >= dead:
                    i = lower[i]
            else:
                depth = len(entry)
                gap = size - depth
                if -1 <= gap <= 1 and rows[depth][gap + 1] == 1:
                    out.append(i)
                i += 1
            if i < count and lcp[i] < depth:
                depth = lcp[i]
        return out


def _bounds(size: int, parts: int) -> list[int]:
    return [q * size // parts for q in range(parts + 1)]


def _scan_range(rows: list[dict], parts: int) -> Iterator[tuple]:
    """Pairs of one share of a range; ``rows`` are sorted by what stands in the part."""
    size, part = rows[0]["size"], rows[0]["part"]
    cuts = _bounds(size, parts)

    def earlier(u: str, v: str) -> bool:
        return any(u[: cuts[q]] == v[: cuts[q]] and u[len(u) - size + cuts[q + 1] :] == v[len(v) - size + cuts[q + 1] :] for q in range(part))

    listed = SortedList([r["middle"] for r in rows])
    for r in rows:
        if not r["scans"]:
            continue
        for j in listed.near(r["middle"]):
            other = rows[j]
            if earlier(r["word"], other["word"]):
                continue
            yield r["word"], r["n"], other["word"], other["n"]
            if len(other["word"]) > size:
                yield other["word"], other["n"], r["word"], r["n"]


def near_pairs(words: DataFrame, parts: int = PARTS, scanners: int = SCANNERS) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of ``words`` (word, n; distinct) that are one edit apart."""
    # The shorter of two words names the range: a word stands in those of its own length and of one less.
    placed = (
        words.select("word", "n", F.explode(F.expr("array(char_length(word), char_length(word) - 1)")).alias("size"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        .withColumn("a", F.expr(f"cast(part * size div {parts} as int)"))
        .withColumn("z", F.expr(f"cast(size - ((part + 1) * size div {parts}) as int)"))
        .select(
            "size",
            "part",
            F.expr("substring(word, 1, a)").alias("before"),
            F.expr("right(word, z)").alias("behind"),
            F.expr("substring(word, a + 1, char_length(word) - a - z)").alias("middle"),
            "word",
            "n",
        )
    )
    key = ["size", "part", "before", "behind"]
    hot = placed.groupBy(*key).count().filter(F.col("count") > scanners)
    hot = hot.select(*key, F.ceil(F.col("count") / scanners).cast("int").alias("shares"))
    dealt = (
        placed.join(hot, key, "left")
        .withColumn("shares", F.coalesce("shares", F.lit(1)))
        .withColumn("share", F.explode(F.expr("sequence(0, shares - 1)")))
        .withColumn("scans", F.expr("char_length(word) = size and pmod(xxhash64(word), shares) = share"))
        .select(*key, "share", "middle", "word", "n", "scans")
    )
    order = [*key, "share"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held).combine_chunks()
            ends = _range_ends(table, order)
            # The last range may go on in the next batch.
            yield _pairs(table, ends[:-1], parts)
            held = [table.slice(ends[-2] if len(ends) > 1 else 0)]
        if held:
            table = pa.concat_tables(held).combine_chunks()
            yield _pairs(table, _range_ends(table, order), parts)

    return (
        dealt.repartition(*order)
        .sortWithinPartitions(*order, "middle")
        .mapInArrow(scan, "word string, n long, near string, near_n long")
    )


def _range_ends(table: pa.Table, order: list[str]) -> list[int]:
    """Where the ranges of a sorted table end."""
    if not table.num_rows:
        return []
    new = np.zeros(table.num_rows - 1, bool)
    for name in order:
        column = table.column(name)
        new |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, table.num_rows - 1)))
    return [*(np.flatnonzero(new) + 1).tolist(), table.num_rows]


def _pairs(table: pa.Table, ends: list[int], parts: int) -> pa.RecordBatch:
    out, start = [], 0
    sizes = np.diff([0, *ends])
    # Most ranges hold one word and are passed over.
    for at in np.flatnonzero(sizes > 1).tolist():
        start = ends[at - 1] if at else 0
        out.extend(_scan_range(table.slice(start, ends[at] - start).to_pylist(), parts))
    columns = list(zip(*out)) if out else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, _PAIRS)], schema=_PAIRS)


# --- the operator ----------------------------------------------------------------


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root): every word with its neighbours by one edit.

    Words are the runs of Latin letters of all texts, A-Z lower-cased, of at least
    ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences; in one of
    ``MODULUS`` pairs of document and run the run has lost a code point (crc32 of
    ``<doc_id>:<run>``).  A word's form is its most frequent neighbour (ties: the
    first in code-point order) if that is at least ``FACTOR`` times as frequent;
    its root is where following the forms ends.

    NULL and empty texts hold no words; a NULL id stands as the empty string
    before the colon; repeated rows count each time; an empty table gives no
    rows.  Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "spellings")
    count_words(docs, doc_id, text).write.parquet(f"{folder}/words")
    words = spark.read.schema("word string, n long").parquet(f"{folder}/words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form")))
    found = (
        near_pairs(words)
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", "best.form", (-F.col("best.rank")).alias("form_n"))
    )
    found.write.parquet(f"{folder}/near")
    near = spark.read.schema("word string, n long, n_near long, form string, form_n long").parquet(f"{folder}/near")
    is_form = F.expr(f"cast(form_n as decimal(38, 0)) >= {FACTOR} * cast(n as decimal(38, 0))")
    links = near.filter(is_form).select("word", F.col("form").alias("root"))

    # Each step of a chain is FACTOR times as frequent, which bounds its length; every round doubles the reach.
    largest = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(largest / MIN_COUNT + 1, FACTOR)) + 1)
    links.write.parquet(f"{folder}/roots-0")
    rounds = math.ceil(math.log2(steps))
    for number in range(rounds):
        links = spark.read.schema("word string, root string").parquet(f"{folder}/roots-{number}")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = links.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        joined.write.parquet(f"{folder}/roots-{number + 1}")
    roots = spark.read.schema("word string, root string").parquet(f"{folder}/roots-{rounds}")

    told = near.select("word", "n_near", F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    return (
        words.join(told, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
