"""Signatures are sorted in shares of a partition, in one shuffle."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from gildstar.llm import jaccard_join


def test_signatures_are_sorted_in_shares_of_a_partition(spark):
    pick = random.Random(5)
    rows = [(pick.randrange(400), pick.randrange(300) if i % 3 else 7) for i in range(900)] + [(1000, 5)] * 4 + [(None, 1), (None, 2)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = jaccard_join.shared_signatures(spark.createDataFrame(rows, "sign long, k1 long"))
    owners = defaultdict(set)
    for sign, key in rows:
        owners[sign].add(key)
    wanted = sorted((str(s), k) for s, keys in owners.items() if len(keys) > 1 for k in keys)
    assert sorted((str(r["sign"]), r["k1"]) for r in shared.collect()) == wanted
    assert shared.rdd.getNumPartitions() == parts
    exchanges = re.findall(r"Exchange (\S+\([^)]*\))", shared._jdf.queryExecution().sparkPlan().toString() + shared._jdf.queryExecution().executedPlan().toString())
    dealt = {int(re.search(r", (\d+)\)", x)[1]) for x in exchanges}
    assert dealt == {jaccard_join.SIGN_SHARES * parts} and jaccard_join.SIGN_SHARES > 1
