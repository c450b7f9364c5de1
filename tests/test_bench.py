import json
import os
import subprocess
import sys

from conftest import SF001

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "avg_connectivity_coords",
                          "hist_weight"], capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and set(d["queries"]) == {"avg_connectivity_coords", "hist_weight"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6
