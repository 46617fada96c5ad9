"""Operator 13 against brute force: words, one-edit pairs, forms and roots."""

from __future__ import annotations

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gildstar.llm.common import importable
from gildstar.llm.queries import QUERIES
from gildstar.llm.spellings import SortedList, crc_after, letter_runs, near_pairs, spelling_groups

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word string, n string, size long, id int"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def one_apart(words):
    """All words by the words with one character left out or exchanged."""
    at = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            at[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = collections.defaultdict(set)
    for group in at.values():
        for a, b in itertools.permutations(group, 2):
            near[a].add(b)
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def brute(rows):
    counts = collections.Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near, form = one_apart(words), {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, t, "w", "n", 1, 2) for i, t in rows], SCHEMA)


def test_scan_equals_the_whole_matrix():
    pick = random.Random(3)
    entries = sorted({"".join(pick.choices("abé", k=pick.randint(0, 6))) for _ in range(400)})
    listed = SortedList(entries)
    for word in [*entries[::5], "", "zzz", "aaaaaaaa", "b"]:
        assert listed.near(word) == [i for i, e in enumerate(entries) if edits(word, e) == 1]


def test_crc_of_joined_strings():
    words = ["", "a", "ab", "straße", "x" * 300]
    prefixes = ["", ":", "17:", "-5:", "123456789012345:"]
    pairs = list(itertools.product(prefixes, words))
    got = crc_after(
        np.array([zlib.crc32(p.encode()) for p, _ in pairs], np.uint32),
        np.array([len(w.encode()) for _, w in pairs]),
        np.array([zlib.crc32(w.encode()) for _, w in pairs], np.uint32),
    )
    assert got.tolist() == [zlib.crc32((p + w).encode()) for p, w in pairs]


def test_runs():
    column = ["Été À-la MODE", "", "ĀÿÀx¿y", "日本abc語", "ab", "cd", "ÃÃ", "áb×÷"]
    runs, counts = letter_runs(pa.array(column, pa.large_string()))
    want = [[w.translate(LOWER) for w in RUN.findall(t)] for t in column]
    assert runs.to_pylist() == [w for ws in want for w in ws] and counts.tolist() == [len(w) for w in want]


def vocabulary(size):
    pick = random.Random(size)
    out = set()
    while len(out) < size:
        word = "".join(pick.choices("abcé", k=pick.randint(6, 9)))
        out.add(word)
        at = pick.randrange(len(word))
        out |= {w for w in (word[:at] + word[at + 1 :], word[:at] + "z" + word[at:]) if len(w) >= 6}
    return sorted(out)


@pytest.mark.parametrize("parts,scanners", [(1, 10**6), (2, 5), (3, 5000), (4, 2), (7, 100)])
def test_pairs_equal_brute_force_whatever_the_ranges(spark, parts, scanners):
    importable(spark)
    words = vocabulary(600)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = collected(near_pairs(df, parts, scanners).select("word", "near"))
    assert got == sorted(((w, x) for w, near in one_apart(set(words)).items() for x in near), key=str)


def texts():
    pick = random.Random(8)
    words = [w for w in vocabulary(60)] + ["Straße", "STRAßE", "short", "naïveté", "naivete"]
    weights = [5 ** (i % 5) for i in range(len(words))]
    rows = [(i, " ".join(pick.choices(words, weights, k=pick.randint(0, 200)))) for i in range(300)]
    rows += [(None, "without an identity " * 9), (None, None), (7, ""), (8, "1234 --"), (3, "repeat " * 9)]
    rows += [(500, "chainaa " * 6 + "chainab " * 40 + "chainbb " * 300)]
    rows += rows[:15] + [(400, "endless " * 40_000), (401, "y" * 3000 + " " + "y" * 2999)]
    return rows


def test_groups_equal_brute_force(spark):
    got, want = collected(spelling_groups(frame(spark, texts()))), brute(texts())
    assert got == want
    assert any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)


def test_empty_table(spark):
    assert spelling_groups(frame(spark, texts()).filter(F.lit(False))).collect() == []


def test_query_equals_brute_force_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_spelling_groups"](spark, "/root/testdata/sf0.01")
    assert collected(got) == brute([(r.doc_id, r.text) for r in docs])
