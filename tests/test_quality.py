"""Checks on seeded bad rows, the suite, and the declared contract."""

from __future__ import annotations

from collections import Counter

import pytest

from gildstar.operators.quality import (
    Check,
    accepted,
    between,
    foreign_key,
    not_null,
    reconcile,
    run_checks,
    unique,
)
from gildstar.plans.contract import contract_checks


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame(
        [(1, "a", 0.0, 10), (1, "b", 100.0, 11), (2, "z", 100.1, 10), (None, None, None, None), (3, "z", -0.1, 12)],
        "id int, label string, pct double, fk int",
    )


def test_single_checks(spark, bad):
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    assert not_null(bad, "id").count() == 1
    assert [tuple(r) for r in unique(bad, "id").collect()] == [(1, 2)]
    assert accepted(bad, "label", ["a", "b"]).count() == 2
    assert [tuple(r) for r in foreign_key(bad, "fk", parent, "pk").collect()] == [(12, 1)]
    assert sorted(r.pct for r in between(bad, "pct", 0, 100).collect()) == [-0.1, 100.1]
    assert between(bad, "pct", low=0).count() == 1 and between(bad, "pct", high=100).count() == 1
    assert between(bad, "pct").count() == 0


def test_reconcile_is_null_safe(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, None)], "a int, b int")
    assert reconcile(df, "a", "b").count() == 2


def test_suite(spark, bad):
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    checks = [
        Check("m", "id", "not_null"),
        Check("m", "id", "unique"),
        Check("m", "label", "accepted_values", values=["a", "b"]),
        Check("m", "pct", "between", low=0, high=100),
        Check("m", "fk", "relationships", parent="p", parent_column="pk"),
        Check("p", "pk", "unique"),
        Check("p", "pk", "relationships", parent="p", parent_column="pk"),
    ]
    got = sorted(tuple(r) for r in run_checks({"m": bad, "p": parent}, checks).collect())
    assert got == sorted(
        [
            ("m", "id", "not_null", 1),
            ("m", "id", "unique", 1),
            ("m", "label", "accepted_values", 2),
            ("m", "pct", "between", 2),
            ("m", "fk", "relationships", 1),
            ("p", "pk", "unique", 0),
            ("p", "pk", "relationships", 0),
        ]
    )


def test_row_checks_of_a_table_share_one_pass(spark, bad):
    checks = [Check("m", "id", "not_null"), Check("m", "label", "not_null"), Check("m", "pct", "between", low=0)]
    plan = run_checks({"m": bad}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_contract_counts():
    checks = contract_checks()
    assert Counter(c.kind for c in checks) == {
        "not_null": 76,
        "between": 20,
        "unique": 13,
        "accepted_values": 9,
        "relationships": 4,
    }
    assert len(set((c.model, c.column, c.kind) for c in checks)) == 122
    assert {c.model for c in contract_checks(["dim_date"])} == {"dim_date"}
