from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import sys
sys.modules["{0}"] = None
import __spark_entry__ as entry
from holdfast.checks.queries import QUERIES
assert set(entry.queries()) == set(QUERIES), sorted(set(entry.queries()) ^ set(QUERIES))
assert set(entry.oracle_sql()) == set(QUERIES)
"""


@pytest.mark.parametrize("absent", ["ahocorasick", "holdfast.llm", "corpus_pipeline"])
def test_the_entry_survives_what_is_absent(absent):
    done = subprocess.run([sys.executable, "-c", PROBE.format(absent)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "text operators left out" in done.stderr
