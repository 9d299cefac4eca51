"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "4", "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(doc)
    assert doc["unit"] == "sec" and doc["value"] > 0 and doc["sf"] == "0.001"
    assert all(v > 0 for v in doc["queries"].values())
