"""Driver contract: bench output format and entry-module surface."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "time_range", "cardinality"],
                         env=env, capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["valid"] is True
    assert set(d["queries"]) == {"time_range", "cardinality"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 39


def test_readme_coverage_table_names_registered_queries():
    import re

    from cumulo.queries import QUERIES
    text = open(os.path.join(ROOT, "README.md")).read()
    table = text.split("## Coverage of SURVEY")[1].split("\n\n")[2]
    named = set()
    for line in table.splitlines():
        cells = [c.strip() for c in line.split("|")]
        if len(cells) > 5 and cells[1].startswith("J"):
            named |= set(re.findall(r"`([a-z_0-9]+)`", cells[4])) - {"entry"}
    assert named and named <= set(E.queries())
    assert set(QUERIES) <= named  # the library's own; others have a section of their own
