"""As-of joins against brute force, hot keys cut by time."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from gildstar.operators.asof import as_of_join

START = datetime(2024, 1, 1)
FACTS = "k string, at timestamp_ntz, n int"
VERSIONS = "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, price int, label string"


def cases():
    rnd = random.Random(11)
    versions = []
    for key, count in [("hot", 150), ("long", 60), *[(f"k{i}", rnd.randrange(4)) for i in range(30)]]:
        starts = sorted(rnd.sample(range(2000), count))
        for i, a in enumerate(starts):
            later = starts[i + 1] if i + 1 < count else None
            # Some histories have gaps: a key that was gone for a while.
            z = later if later is None or rnd.random() < 0.8 else a + max(1, (later - a) // 2)
            versions.append((key, START + timedelta(minutes=a), z and START + timedelta(minutes=z), rnd.randrange(9), None if i % 7 == 0 else f"v{i}"))
    versions += [(None, START, None, 1, "no key"), ("k1", None, None, 2, "no start")]
    facts = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else rnd.choice(["long", "unknown", *[f"k{j}" for j in range(30)]])
        facts.append((key, None if i % 50 == 7 else START + timedelta(minutes=rnd.randrange(-50, 2200)), i))
    facts += [(k, a, -i) for i, (k, a, *_) in enumerate(versions) if k and a]  # exactly at each start
    facts += [(k, z, -1000 - i) for i, (k, _, z, *_) in enumerate(versions) if z]  # exactly at each end
    return facts + facts[:20], versions


def brute(facts, versions, how):
    out = []
    for k, at, n in facts:
        found = [
            (price, label)
            for key, a, z, price, label in versions
            if key is not None and key == k and at is not None and a is not None and a <= at and (z is None or at < z)
        ]
        if found or how == "left":
            out.append((k, at, n, *(found[0] if found else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows_per_task", [20, 500, 10**6])
def test_equals_brute_force(spark, how, rows_per_task):
    facts, versions = cases()
    got = as_of_join(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(versions, VERSIONS),
        ["k"],
        "at",
        ["price", "label"],
        how=how,
        rows_per_task=rows_per_task,
    )
    assert got.columns == ["k", "at", "n", "price", "label"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(facts, versions, how)


def test_no_versions_no_facts(spark):
    facts, versions = cases()
    f, v = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    none = as_of_join(f, v.limit(0), ["k"], "at", ["price"])
    assert none.count() == len(facts) and none.filter("price is not null").count() == 0
    assert as_of_join(f.limit(0), v, ["k"], "at", ["price"]).count() == 0


def test_no_join_of_facts_and_versions(spark):
    facts, versions = cases()
    f, v = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    plan = as_of_join(f, v, ["k"], "at", ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_clashing_columns_and_other_joins_are_refused(spark):
    facts, versions = cases()
    f, v = spark.createDataFrame(facts[:3], FACTS), spark.createDataFrame(versions[:3], VERSIONS)
    with pytest.raises(ValueError):
        as_of_join(f, v.withColumnRenamed("price", "n"), ["k"], "at", ["n"])
    with pytest.raises(ValueError):
        as_of_join(f, v, ["k"], "at", ["price"], how="full")
