"""The six reports as bundles of lazy DataFrames, one per result table.

Each returns ``{result name: DataFrame}``, one Spark action per result. Run
them over a stored fact table (:func:`rollcall.sources.stage_fact`) so the
derivation runs once.

The two bundles with many results over one small intermediate (regional
``Total`` rows: regions x periods; region x type rates: regions x 4) store it
under ``spark.checkpoint.dir`` while they are built, when ``stage`` is set:
that job (and, in ``region_chart``, the search for the periods in that small
table) runs at once, everything else when the caller acts on a result.
:func:`rollcall.session.drop_scratch` removes the stored tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import catalog, catalog_size, filter_fact, members_exist, row_count, search_prefix
from ..schema import REGIONAL, TOTAL
from ..sources.fact_io import store_small
from . import charts, comparison, links, places, regions


def search_la(fact: DataFrame, las: Sequence[str], prefixes: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Enrolments by period for the chosen local authorities."""
    return {
        "catalog_size": catalog_size(fact),
        "matches": search_prefix(fact, list(prefixes)),
        "exists": members_exist(fact, list(las)),
        "enrolments": places.la_enrolment_pivot(fact, las),
    }


def search_type(fact: DataFrame, school_type: str, year) -> dict[str, DataFrame]:
    """National authorised absence for one school type and year."""
    return {
        "school_types": catalog(fact, "school_type"),
        "authorised": places.school_type_authorised(fact, school_type, year),
        "breakdown": places.school_type_breakdown(fact, school_type, year),
    }


def search_unauth(fact: DataFrame, year, by: str = "region", page_number: int = 1, page_size: int = 10) -> dict[str, DataFrame]:
    """Unauthorised absence in a year by region or LA: total rows and one page."""
    full = places.unauthorised_by(fact, year, by)
    return {
        "rows": row_count(full),
        "page": places.unauthorised_page(fact, year, by, page_number, page_size),
    }


def compare_la(
    fact: DataFrame, la1: str, la2: str, year, first_year: int | None = None, last_year: int | None = None
) -> dict[str, DataFrame]:
    """Two local authorities side by side in one year (arguments checked, the
    year against the bounds if any are given; ``exists`` tells whether each
    place occurs at all)."""
    comparison.check_comparison_args(la1, la2, year, first_year, last_year)
    return {
        "exists": members_exist(fact, [la1, la2]),
        "basic": comparison.compare_basic(fact, la1, la2, year),
        "authorised": comparison.compare_authorised(fact, la1, la2, year),
        "unauthorised": comparison.compare_unauthorised(fact, la1, la2, year),
        "summary": comparison.compare_verdicts(fact, la1, la2, year),
    }


def region_chart(fact: DataFrame, periods: Sequence[int] | None = None, stage: bool = True) -> dict[str, DataFrame]:
    """Regional performance over time."""
    regional = filter_fact(fact, geographic_level=REGIONAL, school_type=TOTAL)
    if stage:
        regional = store_small(regional, "regional")
        if periods is None:
            found = regional.select("time_period").where("time_period is not null").distinct().orderBy("time_period")
            periods = [r[0] for r in found.toLocalIterator()]
    fact = regional
    return {
        "regional": regional,
        "overall": regions.region_overall_rounded(fact, periods),
        "trends": regions.region_change(fact),
        "improved": regions.region_improved(fact),
        "worsened": regions.region_worsened(fact),
        "averages": regions.region_average(fact),
        "best": regions.region_best(fact),
        "worst": regions.region_worst(fact),
        "chart": charts.chart_region_trend(fact),
    }


def explore_link(fact: DataFrame, year=None, k: int = 5, stage: bool = True) -> dict[str, DataFrame]:
    """School type x region in one year (default: the latest period)."""
    rates = links.region_type_rates(fact, year)
    if stage:
        rates = store_small(rates, "region-type-rates")
    return {
        "rates": rates,
        "top_regions": links.top_regions_by_type(rates, k),
        "highest": links.highest_by_type(rates),
        "type_averages": links.type_averages(rates),
        "type_gap": links.type_gap(rates),
        "ranges": links.region_range_by_type(rates),
        "most_variable": links.most_variable_type(rates),
        "consistent": links.consistent_regions(rates),
        "phase_gap": links.phase_unauth_gap(rates),
        "findings": links.key_findings(rates),
        "chart_bars": charts.chart_region_type(rates),
        "chart_auth_unauth": charts.chart_type_auth_unauth(rates),
        "chart_heatmap": charts.chart_heatmap(rates),
    }


REPORTS = {
    "search_la": search_la,
    "search_type": search_type,
    "search_unauth": search_unauth,
    "compare_la": compare_la,
    "region_chart": region_chart,
    "explore_link": explore_link,
}
