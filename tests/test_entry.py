"""The driver's entry without optional parts."""

from __future__ import annotations

import subprocess
import sys

import pytest

from .conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert "build_fact" in q and "build_fact" in o
print(len([n for n in q if not n.startswith("op") and n != "pipeline"]), any(n.startswith("op") for n in q), "pipeline" in q)
"""


def found(*blocked):
    code = CODE.format(root=ROOT, blocked=list(blocked))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=False)
    assert out.returncode == 0, out.stderr
    n, ops, pipeline = out.stdout.split()
    return int(n), ops, pipeline


@pytest.mark.parametrize("blocked", ["rollcall.llm", "xxhash", "corpus_pipeline"])
def test_reports_survive_missing_parts(blocked):
    from rollcall.registry import queries

    n, ops, pipeline = found(blocked)
    assert n == len(queries()) and pipeline == "False"
    if blocked != "corpus_pipeline":
        assert ops == "False"
