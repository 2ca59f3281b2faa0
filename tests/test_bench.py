"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2",
               BENCH_QUERIES="page_views_hourly,hot_items_topn")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"page_views_hourly", "hot_items_topn"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
