"""Operator 12 against brute force, its parsing on its own, and its arithmetic beyond 64 bits."""

from __future__ import annotations

import collections
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gildstar.llm.common import importable
from gildstar.llm.phrases import OVERLAP, Words, chunk_dictionary, collocations, parse, rank_phrases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BREAK = re.compile("[.,;:!?\n\x0b\x0c\r]")
SCHEMA = "doc_id long, text string, lang string, chunk string, freq string, n long, a int, phrase int"


def pieces(text):
    return [[w for w in re.split("[ \t]+", p) if w] for p in BREAK.split((text or "").translate(LOWER))]


def brute(rows, min_count, covered=80, top=2000):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for words in pieces(text):
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    counts[lang or "und"][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        kept = []
        for p, a in found.items():
            best = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
                if len(q) > len(p)
            )
            if not inside:
                kept.append((-best[0], -a, " ".join(p).encode(), f[p[: best[1]]], f[p[best[1] :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts():
    pick = random.Random(5)
    words = ["New", "york", "NEW", "été", "Été", "ß", "日本", "a", "in", "x-y", "it's", "#1"]
    rows = []
    for i in range(120):
        parts = [" ".join(pick.choices(words, k=pick.randint(0, 9))) for _ in range(pick.randint(1, 6))]
        rows.append((pick.choice(["en", "fr", None, "und"]), pick.choice(". ,|!|\n|\t|;; ".split("|")).join(parts)))
    rows += [("en", None), ("en", ""), (None, " .,; \n"), ("fr", "in new york city " * 40), ("fr", "a " * 500)]
    return rows + rows[:20]  # repeated rows


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(1, t, g, "c", "f", 1, 2, 3) for g, t in rows], SCHEMA)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("trigger,bits", [(1, 1 << 16), (2, 64), (16, 1 << 26)])
def test_equals_brute_force_whatever_the_parse_and_the_filter(spark, trigger, bits):
    got = collocations(frame(spark, texts()), min_count=6, trigger=trigger, bits=bits)
    want = brute(texts(), 6)
    assert collected(got) == want and len(want) > 30


def test_top_and_empty(spark):
    docs = frame(spark, texts())
    assert collected(collocations(docs, min_count=6, top=3)) == brute(texts(), 6, top=3)
    assert len(collocations(docs, min_count=6, top=None).collect()) >= len(brute(texts(), 6))
    assert collocations(docs.filter(F.lit(False))).collect() == []


@pytest.mark.parametrize("trigger", [1, 2, 5])
def test_every_start_belongs_to_one_chunk(trigger):
    pick = random.Random(trigger)
    column = [" ".join(pick.choices("abcdef", k=pick.randint(0, 40))) + pick.choice([".", "", " "]) for _ in range(50)]
    words = Words(pa.array(column, pa.large_string()))
    begins, ends, last = parse(words, trigger)
    starts = [i for a, b, z in zip(begins, ends, last) for i in range(a, b if z else b - OVERLAP)]
    assert starts == list(range(len(words)))
    # Whatever starts in a chunk ends in it.
    assert all(z or b - a > OVERLAP for a, b, z in zip(begins, ends, last))


def test_equal_passages_give_equal_chunks(spark):
    passage = " ".join(f"w{i}" for i in range(400))
    rows = [("en", f"{'lead ' * i}{passage}") for i in range(5)]
    freq = [r.freq for r in chunk_dictionary(frame(spark, rows), trigger=4).collect()]
    assert sum(x == 5 for x in freq) > len(freq) // 2


def test_products_beyond_64_bits(spark):
    big = 4 * 10**18
    rows = [("en", 1, "x", big), ("en", 1, "y", big), ("en", 2, "x y", big - 1)]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, freq long")
    totals = spark.createDataFrame([("en", 8 * 10**18)], "lang string, n long")
    got = rank_phrases(counts, totals, 80, None).collect()[0]
    assert got.score == 2000000 * (big - 1) // (2 * big) == 999999 and got.a == big - 1
