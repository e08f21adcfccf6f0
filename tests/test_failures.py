"""Surrogate keys survive task retries (a lost executor re-runs its tasks)."""

import json
import subprocess
import sys
from pathlib import Path


def test_keys_survive_task_retries():
    probe = Path(__file__).with_name("failure_probe.py")
    res = subprocess.run([sys.executable, str(probe)], capture_output=True, text=True, timeout=600)
    lines = [l for l in res.stdout.splitlines() if l.startswith("{")]
    assert lines, res.stderr[-2000:]
    assert json.loads(lines[-1]) == {"assign_surrogate": True, "number_scan": True, "scd2": True}
