"""Properties over the derived fact table and over generated rows."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.operators import check_grain, page
from rollcall.plans import charts, links, places, regions
from rollcall.sources import absence

from .conftest import SF_SMALL


def test_grain_is_unique_and_reasons_sum(spark):
    fact = absence(spark, SF_SMALL)
    assert check_grain(fact).count() == 0
    auth = ["illness", "appointments", "religious", "study", "traveller", "holiday", "ext_holiday", "excluded", "other"]
    unauth = ["late", "holiday", "other", "noyet"]
    bad = fact.where(
        (sum(F.col(f"sess_auth_{c}") for c in auth) != F.col("sess_authorised"))
        | (sum(F.col(f"sess_unauth_{c}") for c in unauth) != F.col("sess_unauthorised"))
        | (F.col("sess_overall") != F.col("sess_authorised") + F.col("sess_unauthorised"))
    )
    assert bad.count() == 0


def test_levels_add_up(spark):
    fact = absence(spark, SF_SMALL).cache()
    try:
        def total(level, school_type="Total"):
            return dict(
                fact.where((F.col("geographic_level") == level) & (F.col("school_type") == school_type))
                .groupBy("time_period").agg(F.sum("enrolments").alias("n"), F.sum("num_schools").alias("s"))
                .select("time_period", F.struct("n", "s")).collect()
            )

        nat = total("National")
        assert nat == total("Regional") == total("Local authority")
    finally:
        fact.unpersist()


def test_improved_worsened_partition_regions(spark):
    fact = absence(spark, SF_SMALL)
    change = regions.region_change(fact).cache()
    all_regions = {r.region_name for r in change.collect()}
    improved = {r.region_name for r in regions.region_improved(fact).collect()}
    worsened = {r.region_name for r in regions.region_worsened(fact).collect()}
    same = {r.region_name for r in change.where((F.col("change") == 0) | F.col("change").isNull()).collect()}
    assert improved | worsened | same == all_regions
    assert not (improved & worsened)
    change.unpersist()


def test_pages_concatenate_to_whole(spark):
    fact = absence(spark, SF_SMALL)
    whole = [tuple(r) for r in places.unauthorised_by(fact, 2018, "la").collect()]
    pages = []
    for n in range(1, len(whole) // 7 + 2):
        pages += [tuple(r) for r in places.unauthorised_page(fact, 2018, "la", n, 7).collect()]
    assert pages == whole
    keyed, after = [], None
    while rows := places.unauthorised_page_after(fact, 2018, "la", after, 7).collect():
        keyed += [tuple(r) for r in rows]
        after = (rows[-1].absences, rows[-1].la_name)
    assert keyed == whole


def test_pivot_long_round_trip(spark):
    fact = absence(spark, SF_SMALL)
    rates = links.region_type_rates(fact, 2018).cache()
    heat = {(r.region_name, r.school_type): r.absence_rate for r in charts.chart_heatmap(rates).collect()}
    long = {
        (r.region_name, r.school_type): r.overall_absence_rate
        for r in rates.where(F.col("school_type") != "Total").collect()
    }
    assert {k: v for k, v in heat.items() if k in long} == long
    assert all(v == 0.0 for k, v in heat.items() if k not in long)
    rates.unpersist()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=30),
    st.integers(min_value=1, max_value=6),
)
def test_paging_matches_python(spark, values, size):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, v long")
    expect = sorted(enumerate(values), key=lambda t: (-t[1], t[0]))
    got = []
    for n in range(1, len(values) // size + 2):
        got += [(r.k, r.v) for r in page(df, [F.desc("v"), F.asc("k")], n, size).collect()]
    assert got == expect


def test_report_bundles_match_operators(spark):
    from rollcall.plans import reports

    fact = absence(spark, SF_SMALL)
    chart = reports.region_chart(fact)
    assert sorted(chart["trends"].collect()) == sorted(regions.region_change(fact).collect())
    assert sorted(chart["overall"].collect()) == sorted(regions.region_overall_rounded(fact).collect())
    link = reports.explore_link(fact, 2018, 3)
    assert sorted(link["findings"].collect()) == sorted(links.key_findings(links.region_type_rates(fact, 2018)).collect())
    assert sorted(link["top_regions"].collect()) == sorted(
        links.top_regions_by_type(links.region_type_rates(fact, 2018), 3).collect()
    )
    unauth = reports.search_unauth(fact, 2018, "la", 1, 5)
    assert unauth["rows"].collect()[0].rows == places.unauthorised_by(fact, 2018, "la").count()


NAMES = st.text(alphabet="aAbB_%x", min_size=1, max_size=4)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(NAMES, min_size=1, max_size=12), st.lists(NAMES, min_size=1, max_size=3))
def test_search_prefix_matches_brute_force(make_fact, names, prefixes):
    from rollcall.operators import search_prefix

    df = make_fact([{"la_name": n} for n in names])
    got = {(r.prefix, r.la_name) for r in search_prefix(df, prefixes).collect()}
    want = {(p.lower(), n) for p in prefixes for n in set(names) if n.lower().startswith(p.lower())}
    assert got == want


REASON_VALUES = st.one_of(st.none(), st.integers(min_value=0, max_value=3))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(REASON_VALUES, min_size=12, max_size=12), min_size=1, max_size=6))
def test_main_reason_matches_brute_force(make_fact, rows):
    from rollcall.functions import main_reason
    from rollcall.schema import MAIN_REASONS

    facts = [{"la_name": str(i), **{c: v for (_, c), v in zip(MAIN_REASONS, vals)}} for i, vals in enumerate(rows)]
    got = dict(make_fact(facts).select("la_name", main_reason().alias("r")).collect())
    for i, vals in enumerate(rows):
        present = [(v, -j) for j, v in enumerate(vals) if v is not None]
        want = MAIN_REASONS[-max(present)[1]][0] if present else None
        assert got[str(i)] == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("gh"), st.sampled_from("pqrst"), st.integers(0, 3)), min_size=1, max_size=15),
    st.integers(min_value=1, max_value=4),
)
def test_top_k_matches_brute_force(spark, rows, k):
    from rollcall.operators import top_k_per_group

    uniq = {(g, n): v for g, n, v in rows}  # one row per (group, name)
    df = spark.createDataFrame([(g, n, v) for (g, n), v in uniq.items()], "g string, n string, v long")
    got = {(r.g, r["rank"], r.n) for r in top_k_per_group(df, ["g"], [F.desc("v"), F.asc("n")], k).collect()}
    want = set()
    for g in {g for g, _ in uniq}:
        ranked = sorted(((v, n) for (gg, n), v in uniq.items() if gg == g), key=lambda t: (-t[0], t[1]))
        want |= {(g, i + 1, n) for i, (_, n) in enumerate(ranked[:k])}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(
    st.tuples(st.sampled_from(["R1", "R2", "R3"]), st.sampled_from([201213, 201314, 201415])),
    st.integers(min_value=0, max_value=20).map(lambda x: x / 4),
    min_size=1,
))
def test_region_change_matches_brute_force(make_fact, cells):
    facts = [
        {"time_period": p, "geographic_level": "Regional", "school_type": "Total", "region_name": r,
         "sess_overall_percent": v}
        for (r, p), v in cells.items()
    ]
    got = {r.region_name: r for r in regions.region_change(make_fact(facts)).collect()}
    lo, hi = min(p for _, p in cells), max(p for _, p in cells)
    for region in {r for r, _ in cells}:
        first, last = cells.get((region, lo)), cells.get((region, hi))
        vals = [v for (r, _), v in cells.items() if r == region]
        row = got[region]
        assert row.first_period == first and row.last_period == last
        assert row.change == (None if first is None or last is None else round(last - first, 4))
        assert row.avg_absence == round(sum(vals) / len(vals), 4)
        want = None if row.change is None else ("same" if row.change == 0 else "better" if row.change < 0 else "worse")
        assert row.indicator == want
