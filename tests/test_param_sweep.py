"""The registered queries under other parameters, against the oracle.

The checked scenario of each query is one parameter choice; here the
parameters move (other places and years, a place with no row, other k,
prefixes and pages) and Spark and DuckDB are compared again on the same
tables.
"""

from __future__ import annotations

import pytest

from rollcall import params as P
from rollcall.oracle import oracle_sql
from rollcall.registry import queries

from .conftest import SF_SMALL
from .test_oracle import oracle_check

SWEEP = [
    # NATION_23 has no LA Total row in 201819 at sf0.001: a missing place.
    ({"COMPARE": {"la1": "NATION_23", "la2": "NATION_4", "year": 2018}},
     ["compare_basic", "compare_authorised", "compare_unauthorised", "compare_verdicts"]),
    ({"COMPARE": {"la1": "NATION_9", "la2": "NATION_0", "year": 2012}},
     ["compare_basic", "compare_verdicts"]),
    ({"LINK_YEAR": 2013, "TOP_K": 1},
     ["top_regions_by_type", "type_gap", "region_range_by_type", "consistent_regions_min1", "key_findings",
      "chart_heatmap"]),
    ({"LINK_YEAR": 2016, "TOP_K": 5}, ["top_regions_by_type", "phase_unauth_gap", "most_variable_type"]),
    ({"PREFIXES": ["n", "NATION_2", "nation_x", "%"]}, ["search_prefix"]),
    ({"PIVOT_LAS": ["NATION_23", "NATION_3", "NOWHERE"]}, ["la_enrolment_pivot"]),
    ({"PAGE": {"year": 2014, "by": "la", "page_number": 3, "page_size": 10}}, ["page", "unauthorised_row_count"]),
    ({"PAGE": {"year": 2014, "by": "region", "page_number": 2, "page_size": 2}}, ["page", "unauthorised_row_count"]),
    ({"PAGE": {"year": 2016, "by": "region", "page_number": 1, "page_size": 3}, "PAGE_AFTER": (1804, "AFRICA")}, ["page_after"]),
    ({"PAGE": {"year": 2016, "by": "la", "page_number": 1, "page_size": 4}, "PAGE_AFTER": (200, "NATION_3")}, ["page_after"]),
    ({"FILTER_FACT": {"year": 2015, "geographic_level": "Regional", "school_type": "Special", "region_name": ["ASIA", "EUROPE"]}}, ["filter_fact"]),
    ({"FILTER_FACT": {"year": [2014, 2016], "geographic_level": ["National", "Regional"], "school_type": ["Total", "Special"]}}, ["filter_fact"]),
    ({"FILTER_FACT": {"geographic_level": "National"}}, ["filter_fact"]),
    ({"TYPE_SEARCH": {"school_type": "State-funded primary", "year": 2013}},
     ["school_type_authorised", "school_type_breakdown"]),
    ({"REASON_YEAR": 2012, "FIELDS_YEAR": 2014}, ["main_absence_reason", "fields_unauthorized_percent"]),
]


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF_SMALL)


@pytest.mark.parametrize("overrides,names", SWEEP, ids=[",".join(o) for o, _ in SWEEP])
def test_sweep(spark, con, shared_fact, monkeypatch, overrides, names):
    for key, value in overrides.items():
        monkeypatch.setattr(P, key, value)
    qs, sql = queries(), oracle_sql()
    for name in names:
        df = qs[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        res = con.execute(sql[name])
        ok, exact, msg = oracle_check.compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
        assert ok, (name, msg)
        if name in ("page", "page_after", "filter_fact"):
            assert rows, name
