"""bench.py prints one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEAT="1", BENCH_CPUS="2",
               REVIEWLAKE_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, "bench.py", "language_tag", "crawl_progress"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["metric"] and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"language_tag", "crawl_progress"} and "errors" not in rec
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
