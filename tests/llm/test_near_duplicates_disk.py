"""What the search for near duplicates keeps on disk: no shuffle of a written table, no set that can have no similar one."""

from __future__ import annotations

import glob
import random

import numpy as np
from pyspark.sql import DataFrameWriter

from gildstar.llm import jaccard_join

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def similar(a, b, percent):
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def test_similar_sets_share_as_many_signatures_as_said():
    draw, seen, least_room = np.random.default_rng(3), 0, 99
    for turn in range(400):
        percent = (80, 90)[turn % 2]
        size = int(draw.integers(5, 30 if turn % 3 else 700))
        a = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        edits = draw.integers(0, size * (100 - percent) // 100 + 1, 2)
        b = np.delete(a, draw.choice(len(a), edits[0], replace=False))
        b = np.unique(np.concatenate([b, draw.integers(0, 1 << 63, edits[1]).astype(np.uint64)]))
        if np.array_equal(a, b) or not similar(a, b, percent):
            continue
        seen += 1
        owner, sign = jaccard_join.signatures([a, b], percent)
        shared = np.intersect1d(sign[owner == 0], sign[owner == 1])
        room = np.bincount(shared & 1, minlength=2) - jaccard_join.least_shared([a, b], percent).max(0)
        assert room.max() >= 0
        least_room = min(least_room, room.max())
    assert seen > 100 and least_room < 3


def rows_of_texts():
    pick = random.Random(9)
    phrase = [f"p{i}" for i in range(120)]
    words = [[f"w{k}x{i}" for i in range(400)] for k in range(12)]
    for own in words[:8]:  # one passage in common, else unlike
        own[100:220] = phrase
    words[9] = words[8][:390] + [f"y{i}" for i in range(10)]  # near copies
    words[11] = words[10]  # copies
    texts = [" ".join(w) for w in words]
    pick.shuffle(texts)
    return [(i + 1, t) for i, t in enumerate(texts)] + [(None, texts[0]), (90, None), (91, " \t"), (92, texts[1]), (92, texts[2])]


def test_stored_sets_and_shuffles_of_components(spark, tmp_path, monkeypatch):
    rows, settings, folder = rows_of_texts(), {}, str(tmp_path / "run")
    write = DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        settings[path] = spark.conf.get(CLEANUP)
        return write(self, path, *args, **kwargs)

    before = spark.conf.get(CLEANUP)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(jaccard_join, "run_folder", lambda *_: folder)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(docs, 5, 80).collect()}
    assert set(settings.values()) == {"true"} and len(settings) > 10 and spark.conf.get(CLEANUP) == before

    sets = jaccard_join.shingle_sets(jaccard_join.pa.array([t or "" for _, t in rows]), 5)
    group = [i for i, _ in rows]
    linked = [(x, y) for x, a in enumerate(sets) for y, b in enumerate(sets) if group[x] and group[y] and len(a) and len(b) and similar(a, b, 80)]
    for x, y in linked * len(rows):
        group[x] = group[y] = min(group[x], group[y])
    assert found == {(i, g) for (i, _), g in zip(rows, group)}

    # Unlike sets that share the signatures of a passage are not stored, near copies are.
    shared = {r["k1"] for r in spark.read.parquet(f"{folder}/shared").collect()}
    stored = spark.read.parquet(f"{folder}/sets").select("doc_id").distinct().count()
    assert 2 <= stored < len(shared) and not glob.glob(f"{folder}/differences")
