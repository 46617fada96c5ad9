"""Memory that Python workers keep between tasks."""

from __future__ import annotations

import os
import platform
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import re
import numpy as np
from gildstar.llm.common import giving_back

pinned = []

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

@giving_back
def run(batches):
    for batch in batches:
        pieces = [np.ones(1000) for _ in range(batch)]
        pinned.append(pieces[-1])  # lies behind all others, so the C library keeps what they took
        yield held()

start, most = held(), list(run(iter([10_000, 20_000])))
print(start, max(most), held())
"""


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="only glibc is asked to give back")
def test_worker_gives_back_what_a_task_took():
    """A task takes 150 MB and more, its worker keeps little of it."""
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True)
    start, most, end = map(int, done.stdout.split() or pytest.fail(done.stderr))
    assert most - start > 150
    assert end - start < 30


def test_worker_gives_back_when_a_task_ends_early(monkeypatch):
    from gildstar.llm import common

    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    rows = common.giving_back(lambda batches: (b for b in batches))(iter([1, 2]))
    assert next(rows) == 1 and not calls
    rows.close()
    assert calls == [1]
