"""bench.py runs end to end and prints one JSON line."""

import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=900, check=True).stdout.strip().splitlines()
    result = json.loads(out[-1])
    assert result["unit"] == "sec" and result["sf"] == "0.001" and result["value"] > 0
    assert {"gold_build", "gold_dq_suite", "gold_q1_late_delivery_rate"} <= set(result["queries"])
