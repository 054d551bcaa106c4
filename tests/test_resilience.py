"""Jobs give the same results when tasks are lost and retried."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def _run(fail: bool, folder) -> dict:
    out = str(folder / f"{fail}.json")
    subprocess.run([sys.executable, os.path.join(HERE, "resilience_run.py"), "1" if fail else "0", out],
                   check=True, timeout=900, capture_output=True)
    with open(out) as f:
        return json.load(f)


def test_results_survive_task_retries(tmp_path):
    assert _run(True, tmp_path) == _run(False, tmp_path)
