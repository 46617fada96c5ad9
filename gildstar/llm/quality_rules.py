"""Quality rules as a short-circuit cascade (operator 7).

The base measures of a text are computed for all texts.  The rules of the
cascade say which texts to reject; a text counts as good only if none does, so
their order never changes the result.  The cost and the rejected share of each
rule are measured on a sample, and the rules run by falling rejection per cost,
each only on the texts that no rule before it rejected.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.llm.common import encode_words, large_texts, mix64, slices, split_words

SAMPLE_ROWS = 2_000  # texts the order of the rules is estimated on, about
WINDOW = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """``rejects(texts)`` gives a boolean array, true where a text is rejected."""

    name: str
    rejects: Callable[[pa.Array], np.ndarray]


def base_measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    count = len(texts)
    words, n_words = split_words(texts)
    codes, distinct = encode_words(words)
    owner = np.repeat(np.arange(count), n_words)

    def summed(of_distinct: pa.Array) -> np.ndarray:
        each = of_distinct.to_numpy(zero_copy_only=False).astype(np.int64)
        return np.bincount(owner, each[codes] if len(codes) else None, count).astype(np.int64)

    lists = pc.split_pattern(texts, "\n")
    line_codes, lines = encode_words(lists.flatten())
    line_owner = np.repeat(np.arange(count), np.diff(lists.offsets.to_numpy()))
    with_word = np.asarray(pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]"))
    filled = with_word[line_codes] if len(line_codes) else np.zeros(0, bool)
    line_codes, line_owner = line_codes[filled], line_owner[filled]
    first = np.unique(line_owner * max(1, len(lines)) + line_codes) // max(1, len(lines))
    return {
        "n_words": n_words,
        "word_chars": summed(pc.utf8_length(distinct)),
        "n_symbols": summed(pc.count_substring_regex(distinct, r"[#*$%&|<>]")),
        "n_dup_lines": np.bincount(line_owner, minlength=count) - np.bincount(first, minlength=count),
        "n_repeat_words": _repeat_words(codes, owner, count),
    }


def _repeat_words(codes: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Words per text that lie in a window of five words found twice or more in the text."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.zeros(count, np.int64)
    inside = owner[WINDOW - 1 :] == owner[:n]
    hashed = mix64(owner[:n].astype(np.uint64))
    for i in range(WINDOW):
        hashed = mix64(hashed * _MULTIPLIER + codes[i : i + n].astype(np.uint64))
    start = np.flatnonzero(inside)
    _, group, times = np.unique(hashed[start], return_inverse=True, return_counts=True)
    start = start[times[group] > 1]
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edges[:-1]) > 0], minlength=count)


def _share(texts: pa.Array, of_word: Callable[[pa.Array], pa.Array]) -> np.ndarray:
    """The share of each text's words for which ``of_word`` (over distinct words) is true."""
    words, n_words = split_words(texts)
    codes, distinct = encode_words(words)
    true = np.asarray(of_word(distinct), bool)
    owner = np.repeat(np.arange(len(texts)), n_words)
    return np.bincount(owner, true[codes] if len(codes) else None, len(texts)) / np.maximum(1, n_words)


def _odd_word_length(texts: pa.Array) -> np.ndarray:
    words, n_words = split_words(texts)
    owner = np.repeat(np.arange(len(texts)), n_words)
    chars = np.bincount(owner, pc.utf8_length(words).to_numpy(zero_copy_only=False), len(texts))
    mean = chars / np.maximum(1, n_words)
    return (mean < 2) | (mean > 20)


def _symbol_heavy(texts: pa.Array) -> np.ndarray:
    return _share(texts, lambda w: pc.match_substring_regex(w, r"[#*$%&|<>]")) > 0.25


def _shouting(texts: pa.Array) -> np.ndarray:
    def upper(words: pa.Array) -> pa.Array:
        letters = pc.match_substring_regex(words, r"\pL.*\pL")
        return pc.and_(letters, pc.equal(words, pc.utf8_upper(words)))

    return _share(texts, upper) > 0.5


def _wordless(texts: pa.Array) -> np.ndarray:
    return _share(texts, lambda w: pc.match_substring_regex(w, r"\pL")) < 0.5


def _repeated_lines(texts: pa.Array) -> np.ndarray:
    lists = pc.split_pattern(texts, "\n")
    codes, lines = encode_words(lists.flatten())
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    filled = np.asarray(pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]"), bool)[codes]
    codes, owner = codes[filled], owner[filled]
    total = np.bincount(owner, minlength=len(texts))
    different = np.bincount(np.unique(owner * max(1, len(lines)) + codes) // max(1, len(lines)), minlength=len(texts))
    return (total >= 4) & (total - different > 0.5 * total)


def _stuttering(texts: pa.Array) -> np.ndarray:
    words, n_words = split_words(texts)
    codes, _ = encode_words(words)
    owner = np.repeat(np.arange(len(texts)), n_words)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    return np.bincount(owner[same], minlength=len(texts)) > 0.3 * np.maximum(1, n_words)


RULES = (
    Rule("odd_word_length", _odd_word_length),
    Rule("symbol_heavy", _symbol_heavy),
    Rule("shouting", _shouting),
    Rule("wordless", _wordless),
    Rule("repeated_lines", _repeated_lines),
    Rule("stuttering", _stuttering),
)


def rule_order(docs: DataFrame, rules: tuple[Rule, ...], rows: int = SAMPLE_ROWS, text: str = "text") -> list[int]:
    """Rule positions by falling rejection per second, measured in tasks on about ``rows`` texts."""
    schema = pa.schema([("rule", pa.int32()), ("seconds", pa.float64()), ("rejected", pa.int64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = large_texts(part.column("text"))
            found = []
            for number, rule in enumerate(rules):
                began = time.thread_time()
                rejected = int(rule.rejects(texts).sum())
                found.append((number, time.thread_time() - began, rejected))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)

    total = docs.count()
    if not total:
        return list(range(len(rules)))
    measured = (
        docs.select(F.col(text).alias("text"))
        .sample(fraction=min(1.0, rows / total), seed=11)
        .mapInArrow(measure, "rule int, seconds double, rejected long")
        .groupBy("rule")
        .agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
        .collect()  # one row per rule
    )
    gain = {r["rule"]: (r["rejected"] + 0.5) / (r["seconds"] + 1e-6) for r in measured}
    return sorted(range(len(rules)), key=lambda i: -gain.get(i, 0.0))


def good(texts: pa.Array, rules: list[Rule]) -> np.ndarray:
    """True where no rule rejects; each rule sees only the texts left by those before it."""
    left = np.arange(len(texts))
    for rule in rules:
        if not len(left):
            break
        left = left[~rule.rejects(texts.take(pa.array(left)))]
    verdict = np.zeros(len(texts), bool)
    verdict[left] = True
    return verdict


def apply_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) per row.

    A NULL text has no words and one empty line; it fails the base rules, as do
    empty ones.  NULL ids stay NULL; repeated rows give repeated results; an
    empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = [rules[i] for i in rule_order(docs, rules)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = pa.schema(
        [("doc_id", pa.int64())] + [(c, pa.int64()) for c in names] + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = large_texts(part.column("text"))
            base = base_measures(texts)
            failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
            kept = ~failed
            passed = np.flatnonzero(kept)
            if len(passed):
                kept[passed] = good(texts.take(pa.array(passed)), ordered)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id")]
                + [pa.array(base[c].astype(np.int64)) for c in names]
                + [pa.array(failed), pa.array(kept)],
                schema=schema,
            )

    ddl = ", ".join(["doc_id long"] + [f"{c} long" for c in names] + ["base_failed boolean", "kept boolean"])
    return docs.mapInArrow(run, ddl).withColumnRenamed("doc_id", doc_id)
