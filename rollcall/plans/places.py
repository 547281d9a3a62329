"""Place and school-type reports: enrolment by LA, authorised absence by
school type, unauthorised absence by region or LA (with paging)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import filter_fact, page, page_after, query
from ..schema import LOCAL_AUTHORITY, NATIONAL, REGIONAL, TOTAL


def _unique(values: Sequence[str]) -> list[str]:
    seen: dict[str, None] = {}
    for v in values:
        seen.setdefault(v, None)
    return list(seen)


def la_enrolment_pivot(df: DataFrame, las: Sequence[str]) -> DataFrame:
    """Enrolments with periods as rows and the given LAs as columns (one
    column per LA, named by the LA; null where the LA has no row)."""
    las = _unique(las)
    if not las:
        raise ValueError("give at least one local authority")
    rows = filter_fact(df, geographic_level=LOCAL_AUTHORITY, school_type=TOTAL, la_name=las)
    return query(rows, "time_period", fields="enrolments", pivot="la_name", pivot_values=las, unique=True).orderBy("time_period")


def school_type_authorised(df: DataFrame, school_type: str, year) -> DataFrame:
    """National authorised absence sessions for one school type and year:
    ``time_period`` plus one column named by the school type."""
    rows = filter_fact(df, year=year, geographic_level=NATIONAL, school_type=school_type)
    return query(
        rows,
        "time_period",
        fields={"sess_authorised": "authorised"},
        pivot="school_type",
        pivot_values=[school_type],
        unique=True,
    )


def school_type_breakdown(df: DataFrame, school_type: str, year) -> DataFrame:
    """The authorised field set (12 measures) for one school type and year."""
    rows = filter_fact(df, year=year, geographic_level=NATIONAL, school_type=school_type)
    return query(rows, "time_period", fields="authorized", unique=True)


_BY = {"region": (REGIONAL, "region_name"), "la": (LOCAL_AUTHORITY, "la_name")}


def level_of(by: str) -> str:
    """The geographic level that a report by ``by`` reads."""
    if by not in _BY:
        raise ValueError("by must be 'region' or 'la'")
    return _BY[by][0]


def unauthorised_by(df: DataFrame, year, by: str = "region") -> DataFrame:
    """Unauthorised absence field set for one year, by region or by LA, most
    absences first (ties by name)."""
    level, key = level_of(by), _BY[by][1]
    rows = filter_fact(df, year=year, geographic_level=level, school_type=TOTAL)
    return query(rows, key, fields="unauthorized", unique=True).orderBy(F.desc_nulls_last("absences"), F.asc(key))


def unauthorised_page(df: DataFrame, year, by: str = "la", page_number: int = 1, page_size: int = 10) -> DataFrame:
    """One page of :func:`unauthorised_by`, in the same order."""
    full = unauthorised_by(df, year, by)
    return page(full, [F.desc_nulls_last("absences"), F.asc(_BY[by][1])], page_number, page_size)


def unauthorised_page_after(df: DataFrame, year, by: str = "la", after: tuple | None = None, page_size: int = 10) -> DataFrame:
    """The ``page_size`` rows of :func:`unauthorised_by` that follow ``after``,
    the (absences, name) of the last row seen (None: the first page)."""
    level_of(by)
    return page_after(unauthorised_by(df, year, by), "absences", _BY[by][1], after, page_size)
