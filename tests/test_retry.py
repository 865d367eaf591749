"""Recomputed tasks give the same row ids and line numbers (executor loss)."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def run(path, mode):
    out = subprocess.run([sys.executable, os.path.join(HERE, "retry_job.py"), path, mode],
                         capture_output=True, text=True, timeout=600, check=True)
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_retried_tasks_reproduce_ids(tmp_path):
    p = tmp_path / "cap.txt"
    p.write_text("".join(f"10.0.{i // 250}.{i % 250}:{i % 1000}\n" for i in range(3000)))
    clean, failed = run(str(p), "clean"), run(str(p), "fail")
    assert len(clean["obs"]) == 3000 and [n for n, _ in clean["numbered"]] == list(range(1, 3001))
    assert failed == clean
