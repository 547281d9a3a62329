"""Physical-plan checks: pruning, pushdown, no single-partition windows, no
Python in any plan, top-k as WindowGroupLimit, pre-aggregation before joins."""

from __future__ import annotations

import contextlib
import io

import pytest

from rollcall.plans import links, places, regions
from rollcall.session import scratch_path
from rollcall.sources import absence, read_fact, write_fact

from .conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored_fact(spark):
    path = scratch_path(spark, "test-fact")
    write_fact(absence(spark, SF_SMALL), path)
    return read_fact(spark, path)


def test_derivation_prunes_columns_and_preaggregates(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(absence(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the four lineitem columns the mapping needs are read.
    assert "FileScan parquet [l_orderkey#" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet [l_orderkey" in line][0]
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan
    # Partial aggregate of lineitem precedes its shuffle; no distinct counts.
    assert "partial_sum(cast(l_quantity" in plan
    assert "count(distinct" not in plan.lower()
    # No forced broadcast: with size-based broadcasting off there is none.
    assert "Broadcast" not in plan
    # The grouping-set Expand sits above the finest-grain aggregate.
    expand_at = plan.index("Expand")
    assert plan.index("HashAggregate(keys=[time_period", expand_at) > expand_at


def test_library_has_no_python_udfs_or_driver_loops():
    import pathlib
    import re

    pkg = pathlib.Path(__file__).resolve().parents[1] / "rollcall"
    banned = re.compile(r"\b(udf|pandas_udf|applyInPandas|mapInPandas|mapInArrow|localCheckpoint)\b|\.rdd\b|\.collect\(\)|toPandas\(")
    for path in pkg.rglob("*.py"):
        if "llm" in path.relative_to(pkg).parts:
            continue  # a subpackage of its own kind, tested in tests/llm
        for n, line in enumerate(path.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            assert not banned.search(code), f"{path.name}:{n}: {line.strip()}"


@pytest.mark.parametrize("name", ["build_fact", "compare_verdicts", "main_absence_reason", "key_findings", "search_prefix"])
def test_no_python_in_plans(spark, name):
    from rollcall.registry import queries

    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    for marker in ("PythonUDF", "pythonUDF", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"):
        assert marker not in plan, marker


def test_filters_reach_the_scan(stored_fact):
    df = places.unauthorised_by(stored_fact, 2018, "la")
    plan = formatted(df)
    assert "PartitionFilters: [isnotnull(geographic_level" in plan
    assert "Local authority" in plan
    assert "GreaterThanOrEqual(time_period,201800)" in plan and "LessThanOrEqual(time_period,201899)" in plan


def test_page_has_no_single_partition_window(stored_fact):
    df = places.unauthorised_page(stored_fact, 2018, "la", 2, 10)
    plan = plan_of(df)
    assert "TakeOrderedAndProject" in plan
    assert "SinglePartition" not in plan
    assert "Window" not in plan


def test_top_k_uses_window_group_limit(stored_fact):
    df = links.top_regions_by_type(links.region_type_rates(stored_fact, 2018), 3)
    df.collect()
    plan = plan_of(df)
    assert "WindowGroupLimit" in plan


def test_region_change_is_one_aggregate(stored_fact):
    df = regions.region_change(stored_fact)
    plan = plan_of(df)
    assert "Join" not in plan and "Subquery" not in plan
    assert plan.count("FileScan") == 1


def jobs_while(spark, build):
    """(jobs run while ``build`` makes its frame, the frame)."""
    sc = spark.sparkContext
    sc.setJobGroup("building", "building")
    df = build()
    jobs = len(sc.statusTracker().getJobIdsForGroup("building"))
    sc.setJobGroup("other", "other")
    return jobs, df


STAGED = {"load_roundtrip", "load_fact", "region_overall_pivot", "region_overall_rounded", "fact_by_periods", "fact_one_per_key",
          "fact_of_stored_star", "year_of_stored_star", "fact_of_increments", "csv_accepted", "csv_rejects",
          "ranked_page", "stored_catalog_la", "stored_catalog_size"}


def test_building_a_query_runs_no_job_and_scans_lineitem_once(spark):
    from rollcall.registry import queries

    for name, query in queries().items():
        if name in STAGED:
            continue
        jobs, df = jobs_while(spark, lambda query=query: query(spark, SF_SMALL))
        assert jobs == 0, name
        plan = plan_of(df)
        assert plan.count("FileScan parquet [l_orderkey") == 1, name


def test_pivot_discovery_reads_the_stored_rows_only(spark):
    from rollcall.registry import queries

    df = queries()["region_overall_pivot"](spark, SF_SMALL)
    files = df.inputFiles()
    assert files and all("regional-rates" in f for f in files)


def test_year_and_level_reach_the_derivation(spark):
    from rollcall.registry import queries

    plan = formatted(queries()["fields_enrolments"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01" in plan and "LessThan(o_orderdate,2002-01-01" in plan
    assert "LeftSemi" not in plan  # lines are added up before any join
    df = queries()["unauthorised_by_region"](spark, SF_SMALL)
    # one grouping set: the Expand makes one row of each
    expand = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Expand" in line]
    assert all(line.count("List(") <= 2 or line.count("], [") == 0 for line in expand)


@pytest.mark.parametrize("name", ["fields_authorized", "page", "la_enrolment_pivot"])
def test_field_reports_use_hash_aggregates(spark, name):
    from rollcall.registry import queries

    assert "SortAggregate" not in plan_of(queries()[name](spark, SF_SMALL))
