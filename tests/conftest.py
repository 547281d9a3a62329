from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rollcall.schema import FACT, FACT_COLUMNS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rollcall.session import local_session

    s = local_session(4, shuffle_partitions=4, app="rollcall-tests")
    yield s
    s.stop()


def fact_row(**values):
    """A full 39-column fact row: counts default to 0, rates to 0.0, keys to None."""
    row = {}
    for f in FACT.fields:
        if f.name in values:
            row[f.name] = values[f.name]
        elif f.dataType.typeName() == "long":
            row[f.name] = 0
        elif f.dataType.typeName() == "double":
            row[f.name] = 0.0
        else:
            row[f.name] = None
    return tuple(row[c] for c in FACT_COLUMNS)


@pytest.fixture
def make_fact(spark):
    def build(rows):
        return spark.createDataFrame([fact_row(**r) for r in rows], FACT)

    return build


@pytest.fixture(scope="module")
def shared_fact(spark):
    """Patch the registry so each data directory is derived once per module
    and scope (cached), then every registered query runs on that cached table. The
    derivation itself is still compared with the oracle by ``build_fact``."""
    import rollcall.registry as registry
    from rollcall.sources import absence as derive

    cache = {}

    def memo(spark_, sf_dir, **scope):
        key = (sf_dir, repr(sorted(scope.items())))
        if key not in cache:
            cache[key] = derive(spark_, sf_dir, **scope).cache()
        return cache[key]

    original = registry.absence
    registry.absence = memo
    yield cache
    registry.absence = original
    for df in cache.values():
        df.unpersist()
