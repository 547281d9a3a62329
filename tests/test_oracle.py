"""Every registered query against its DuckDB oracle on the same tables.

Runs at sf0.001 by default (fast; includes a real missing-place case). Set
``ROLLCALL_ORACLE_SF`` to another test-data directory to widen it.
"""

from __future__ import annotations

import os
import sys

import pytest

from .conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import oracle_check  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from rollcall import oracle, registry  # noqa: E402

SF = os.environ.get("ROLLCALL_ORACLE_SF", SF_SMALL)
SQL = oracle.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, shared_fact, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = oracle_check.run_oracle(con, SQL[name])
    ok, exact, msg = oracle_check.compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region_name", "first_period", "last_period", "change", "avg_absence", "indicator"]
    assert df.count() == 5
