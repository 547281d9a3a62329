"""The tables behind the reports' charts (the data, not the pictures)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import query
from ..schema import SCHOOL_TYPES
from .links import AUTH, OVERALL, UNAUTH, _type_means, type_order
from .regions import region_rates

CHART_TYPES = SCHOOL_TYPES[1:]


def chart_region_trend(df: DataFrame) -> DataFrame:
    """One line per region: (region, period, overall absence rate), in order."""
    return region_rates(df).select(
        "region_name", "time_period", F.col("sess_overall_percent").alias("absence_rate")
    ).orderBy("region_name", "time_period")


def _region_by_type(rates: DataFrame) -> DataFrame:
    wide = query(
        rates,
        "region_name",
        fields={OVERALL: OVERALL},
        pivot="school_type",
        pivot_values=CHART_TYPES,
    )
    return wide.fillna(0.0, subset=CHART_TYPES)


def chart_region_type(rates: DataFrame) -> DataFrame:
    """Grouped bars: one row per region, one column per school type (``Total``
    left out), 0.0 where a region lacks a type."""
    return _region_by_type(rates).orderBy("region_name")


def chart_type_auth_unauth(rates: DataFrame) -> DataFrame:
    """Mean authorised and unauthorised rate per school type (all four types,
    rounded to 4), in report order."""
    return (
        _type_means(rates)
        .select(
            "school_type",
            "type_order",
            F.round(AUTH, 4).alias("authorised"),
            F.round(UNAUTH, 4).alias("unauthorised"),
        )
        .orderBy("type_order")
    )


def chart_heatmap(rates: DataFrame) -> DataFrame:
    """Heat-map cells: (region, school type, rate) for every region and each
    non-``Total`` type, 0.0 for a missing cell. The unpivot of the bar table:
    no join of regions with types. Rows in matrix order: region, then type."""
    cells = _region_by_type(rates).unpivot(["region_name"], CHART_TYPES, "school_type", "absence_rate")
    return cells.orderBy("region_name", type_order())
