"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="a1_management_report,p4_mask_documents", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], capture_output=True,
                         text=True, timeout=600, env=env)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    b = json.loads(lines[0])
    assert b["unit"] == "sec" and b["sf"] == 0.001 and isinstance(b["value"], float)
    assert set(b["queries"]) == {"a1_management_report", "p4_mask_documents"}
