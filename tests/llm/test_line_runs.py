"""Operator 11 against brute force, and the levelled runs on their own."""

from __future__ import annotations

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from gildstar.llm.line_runs import LineRuns, drop_repeated_lines, line_postings, summarise
from gildstar.llm.queries import QUERIES
from gildstar.sources import versions

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, id long, h1 string, pos int, docs long, gone string"


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_docs=5, min_chars=40):
    """(doc_id, n_lines, n_dropped, kept) by the rule of the contract; None is the smallest id."""
    low = -(10**30)
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stays = [
            x
            for x in lines
            if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or max(held[key(x)]) == (low if i is None else i)
        ]
        out.append((i, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return sorted(out, key=str)


LICENSE = "This line of the LICENSE is held by several documents of the corpus"
ACCENTS = "Élan vital: UNE LIGNE avec des majuscules accentuées ÉÀÜ répétée"
FORTY, SHORT = "x" * 40, "X" * 39


def texts():
    rows = [(i, f"own line {i}\n{LICENSE}\n\nend") for i in range(8)]
    rows += [(10 + i, f"\t{LICENSE.upper()} \r\n{ACCENTS}\n{LICENSE}") for i in range(4)]
    rows += [(20 + i, ACCENTS.replace("UNE", "une")) for i in range(2)]
    rows += [(30 + i, ACCENTS.replace("É", "é")) for i in range(4)]  # another key: only A-Z are lowered
    rows += [(40 + i, f"{FORTY}\n{SHORT}") for i in range(5)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, " " * 50), (54, "\x0b" + FORTY.upper() + "\x0c")]
    rows += [(None, LICENSE), (None, f"{FORTY}\nno id"), (None, LICENSE)]
    rows += [(3, f"own line 3\n{LICENSE}\n\nend"), (11, f"another text\n{LICENSE}")]
    rows += [(60, "\n".join([LICENSE, FORTY, "z"] * 3000)), (61, "日本語" * 20), (62, "日本語" * 20)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "h", 2, 3, "g") for i, t in rows], SCHEMA)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (5, 3)])
def test_equals_brute_force_whatever_the_batches(spark, batches, fanout):
    docs = frame(spark, texts())
    assert collected(drop_repeated_lines(docs, batches=batches, fanout=fanout)) == brute(texts())


def test_empty_table(spark):
    assert drop_repeated_lines(frame(spark, texts()).filter(F.lit(False))).collect() == []


def test_runs_compact_reopen_and_know_decided_lines(spark, tmp_path):
    folder = str(tmp_path / "runs")
    rows = [(i, "\n".join([LICENSE, f"{i // 2:040d}"])) for i in range(18, 0, -1)]
    for start in range(0, 18, 6):
        store = LineRuns(spark, folder, min_docs=3, fanout=2, buckets=4)
        store.add(line_postings(frame(spark, rows[start : start + 6])))
        store.close()
    store = LineRuns(spark, folder, min_docs=3, fanout=2)
    assert store.buckets == 4 and [r["level"] for r in store.runs()] == [1, 0]
    # The license was decided by the first batch: later runs do not hold it.
    assert store.table(store.runs()[1]).filter("docs >= 3").count() == 0
    got = store.frequent().collect()
    assert [r.keeper for r in got] == [18]
    store.close()


def test_a_larger_id_that_comes_later_becomes_the_keeper(spark, tmp_path):
    store = LineRuns(spark, str(tmp_path / "runs"), min_docs=2, fanout=4, buckets=2)
    for ids in ([1, 2, 3], [9], [4]):
        store.add(line_postings(frame(spark, [(i, LICENSE) for i in ids])))
    assert [r.keeper for r in store.frequent().collect()] == [9]
    store.close()


def test_merging_reads_runs_without_a_shuffle(spark, tmp_path):
    store = LineRuns(spark, str(tmp_path / "runs"), buckets=8)
    store.add(line_postings(frame(spark, texts())))
    run, fresh = store.table(store.runs()[0]), summarise(line_postings(frame(spark, texts())))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    same = (fresh["h1"] == run["h1"]) & (fresh["h2"] == run["h2"]) & (run["keeper"] >= fresh["keeper"])
    joined = plan(fresh.join(run.hint("merge"), same, "left_anti"))
    assert "SortMergeJoin" in joined and joined.count("Exchange") == plan(fresh).count("Exchange")
    store.close()


def test_lost_driver_leaves_the_runs_as_they_were(spark, tmp_path, monkeypatch):
    store = LineRuns(spark, str(tmp_path / "runs"), min_docs=2, buckets=2)
    store.add(line_postings(frame(spark, [(1, LICENSE), (2, LICENSE)])))

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lost)
        with pytest.raises(RuntimeError):
            store.add(line_postings(frame(spark, [(7, LICENSE)])))
    again = LineRuns(spark, str(tmp_path / "runs"), min_docs=2)
    assert [r.keeper for r in again.frequent().collect()] == [2]
    again.add(line_postings(frame(spark, [(7, LICENSE)])))
    assert [r.keeper for r in again.frequent().collect()] == [7]
    again.close()


def test_query_gives_the_digest(spark):
    got = QUERIES["op11_line_dedup"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = [
        (i, n, dropped, hashlib.sha256(kept.encode()).hexdigest())
        for i, n, dropped, kept in brute([(r.doc_id, r.text) for r in docs])
    ]
    assert collected(got) == sorted(want, key=str)
