"""Filters over the fact table. Each is a lazy ``where``; Catalyst merges the
chain into one predicate and pushes it into the Parquet scan (integer ranges,
``IN`` lists and equalities are all pushable)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import period_in_years


def _as_list(values) -> list:
    if isinstance(values, (str, int)):
        return [values]
    return list(values)


def filter_year(df: DataFrame, years: int | str | Iterable[int | str], column: str = "time_period") -> DataFrame:
    """Rows whose period starts in any of ``years`` (``2018`` keeps ``201819``)."""
    return df.where(period_in_years(years, column))


def filter_members(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose ``column`` is one of ``values`` (a scalar or a collection).
    An empty collection keeps no rows."""
    vals = _as_list(values)
    if not vals:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(vals))


def filter_fact(
    df: DataFrame,
    year=None,
    geographic_level=None,
    school_type=None,
    region_name=None,
    la_name=None,
) -> DataFrame:
    """Conjunction of the given filters; an argument left as ``None`` is not
    applied. Each argument takes a scalar or a list (OR within a list)."""
    given = {
        "geographic_level": geographic_level,
        "school_type": school_type,
        "region_name": region_name,
        "la_name": la_name,
    }
    for name, value in [("year", year), *given.items()]:
        if isinstance(value, str) and not value.strip():
            raise ValueError(f"{name} must not be an empty string")
    if year is not None:
        df = filter_year(df, year)
    for column, value in given.items():
        if value is not None:
            df = filter_members(df, column, value)
    return df
