"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from scale import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPS="1", BENCH_CPUS="4")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env, capture_output=True, text=True, timeout=900, check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and d["value"] > 0
    assert isinstance(d["metric"], str) and len(d["queries"]) == 34
    assert all(v > 0 for v in d["queries"].values())
    assert d["plan_shape"]["soc_six_year_certs"]["scans"] == 1
    assert d["join_form_plan_shape"]["soc_six_year_certs"]["joins"] == 6


def test_end_to_end_report_script():
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "run_report.py"), SF_SMALL, "basic"],
        capture_output=True, text=True, timeout=900, check=True,
    ).stdout
    assert out.startswith("1500 records in the clean table.")
    assert "### BASIC QUERIES ###" in out and "MACHINERY NOT SPECIFIED" in out
