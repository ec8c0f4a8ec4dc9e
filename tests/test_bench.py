"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4",
           "BENCH_REPEAT": "1", "BENCH_WARMUP": "0"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec) >= {"metric", "value", "unit", "queries", "sf"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
