from __future__ import annotations

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_counts_stay_exact_when_a_stage_is_repeated(tmp_path):
    job = subprocess.run(
        [sys.executable, os.path.join(HERE, "lost_shuffle_job.py"), str(tmp_path)],
        env={**os.environ, "PYTHONPATH": os.path.dirname(HERE)},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert job.returncode == 0, job.stderr[-2000:]
    assert json.loads(job.stdout.splitlines()[-1]) == {
        "read": 40_000,
        "written": 10_000,
        "found": 10_000,
        "lost": True,
    }
