"""Benchmark: derive and store the fact table, then run the six reports.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line, with wall time, Spark actions and shuffle bytes
written (from the event log) per step. ``build_fact`` derives the fact table from the star
schema and writes it as Parquet partitioned by geographic level (the shared
checkpoint folder); each report then runs on the stored table, as the
analysed application does with its Parquet cache. Each report is timed with
every one of its result DataFrames collected (one Spark action per result).
``e2e_*`` entries run a report straight from the raw tables. The JVM is
warmed first on the sf0.001 tables (``BENCH_WARM_DIR``), not on the measured
data.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tools"))

from rollcall import params as P  # noqa: E402
from rollcall.plans import links, regions, reports  # noqa: E402
from rollcall.schema import REGIONAL  # noqa: E402
from rollcall.session import local_session  # noqa: E402
from rollcall.sources import absence, stage_fact  # noqa: E402
from shuffle_bytes import actions_by_job_group, shuffle_by_job_group  # noqa: E402


def bundles(fact):
    """Report name -> a builder of its result DataFrames (checked parameters).
    Built inside the timed section: any eager planning work counts."""
    return {
        "search_la": lambda: reports.search_la(fact, P.PIVOT_LAS, P.PREFIXES),
        "search_type": lambda: reports.search_type(fact, **P.TYPE_SEARCH),
        "search_unauth": lambda: reports.search_unauth(fact, P.UNAUTH_YEAR, "la", 2, 10),
        "compare_la": lambda: reports.compare_la(fact, **P.COMPARE),
        "region_chart": lambda: reports.region_chart(fact),
        "explore_link": lambda: reports.explore_link(fact, P.LINK_YEAR, 5),
    }


SHARED = ("regional", "rates")  # stored inputs returned with a bundle, not results


def run_bundle(build) -> int:
    frames = build()
    results = [f for k, f in frames.items() if k not in SHARED]
    for f in results:
        f.collect()
    return len(results)


def reference_actions() -> dict[str, int]:
    """Spark actions the analysed application runs for the same requests
    """
    prefixes, places_, pages = len(P.PREFIXES), len(P.PIVOT_LAS), 2
    regions_ = 5
    return {
        "search_la": 3 + max(prefixes, 1) + places_,
        "search_type": 4,
        "search_unauth": 1 + 2 * pages,
        "compare_la": 6 + max(prefixes, 1),
        "region_chart": 10,
        "explore_link": 32 + 6 * regions_,
    }


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def guarded(times: dict, errors: dict, name: str, fn):
    """Time ``fn`` under ``name`` (also its Spark job group); a failure is
    recorded, not fatal, so the JSON line is always printed."""
    from pyspark.sql import SparkSession

    SparkSession.getActiveSession().sparkContext.setJobGroup(name, name)
    try:
        times[name], out = timed(fn)
        return out
    except Exception as e:  # noqa: BLE001
        times[name] = None
        errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        return None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # Event log in a fresh scratch folder: shuffle bytes per step, a measure
    # that does not depend on the machine's load.
    log_dir = tempfile.mkdtemp(prefix="rollcall-bench-events-")
    spark = local_session(
        cpus,
        shuffle_partitions=max(cpus * 2, 8),
        app="rollcall-bench",
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir},
    )

    # Warm the JVM (class loading, JIT, codegen) on the smallest tables, which
    # are not the measured data: the same plan shapes, a fixed cost.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        warm = stage_fact(spark, absence(spark, warm_dir), "bench-warm")
        for build in bundles(warm).values():
            run_bundle(build)

    times: dict[str, float | None] = {}
    actions: dict[str, int] = {}
    errors: dict[str, str] = {}
    fact = guarded(times, errors, "build_fact", lambda: stage_fact(spark, absence(spark, sf_dir), "bench-fact"))
    if fact is not None:
        for name, build in bundles(fact).items():
            n = guarded(times, errors, name, lambda build=build: run_bundle(build))
            if n is not None:
                actions[name] = n
    guarded(times, errors, "e2e_region_change", lambda: regions.region_change(absence(spark, sf_dir)).collect())
    guarded(
        times,
        errors,
        "e2e_explore_link",
        # the derivation's scope as the registered query gives it
        lambda: links.key_findings(links.region_type_rates(absence(spark, sf_dir, [P.LINK_YEAR], [REGIONAL]), P.LINK_YEAR)).collect(),
    )

    spark.stop()
    try:
        shuffle = shuffle_by_job_group(log_dir)
        counted = actions_by_job_group(log_dir)
        actions = {k: counted.get(k, 0) for k in actions}  # eager work counts too
    except Exception:  # noqa: BLE001 - the metric is optional
        shuffle = {}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = sum(v for v in times.values() if v is not None)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: (round(v, 3) if v is not None else None) for k, v in times.items()},
                "spark_actions": actions,
                "reference_spark_actions": reference_actions(),
                "shuffle_bytes": {k: shuffle.get(k, 0) for k in times},
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                **({"errors": errors} if errors else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
