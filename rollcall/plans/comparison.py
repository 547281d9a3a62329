"""Comparison of two local authorities in one year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import main_reason, pct, year_bounds
from ..operators import compare_metrics, filter_fact, lower_wins
from ..schema import (
    AUTHORISED_METRICS,
    BASIC_METRICS,
    LOCAL_AUTHORITY,
    TOTAL,
    UNAUTHORISED_METRICS,
)


def check_comparison_args(la1: str, la2: str, year, first_year: int | None = None, last_year: int | None = None) -> int:
    """Two different places and a four-digit year; with bounds given, a year
    within them."""
    if not la1 or not la2 or la1 == la2:
        raise ValueError("give two different local authorities")
    y = year_bounds(year)[0] // 100
    if (first_year is not None and y < first_year) or (last_year is not None and y > last_year):
        raise ValueError(f"year must be within {first_year or 'any'}-{last_year or 'any'}")
    return y


def comparison_rows(df: DataFrame, la1: str, la2: str, year, **years) -> DataFrame:
    """The (at most two) LA ``Total`` rows being compared."""
    y = check_comparison_args(la1, la2, year, **years)
    return filter_fact(df, year=y, geographic_level=LOCAL_AUTHORITY, school_type=TOTAL, la_name=[la1, la2])


def compare_basic(df: DataFrame, la1: str, la2: str, year, **years) -> DataFrame:
    """Schools, pupils, sessions, the three absence rates and persistent absentees."""
    metrics = [(label, F.col(c), kind) for label, c, kind in BASIC_METRICS]
    return compare_metrics(comparison_rows(df, la1, la2, year, **years), "la_name", la1, la2, metrics)


def compare_authorised(df: DataFrame, la1: str, la2: str, year, **years) -> DataFrame:
    """Authorised reasons as a share of possible sessions."""
    metrics = [(label, pct(c, "sess_possible"), "rate") for label, c in AUTHORISED_METRICS]
    return compare_metrics(comparison_rows(df, la1, la2, year, **years), "la_name", la1, la2, metrics)


def compare_unauthorised(df: DataFrame, la1: str, la2: str, year, **years) -> DataFrame:
    """Unauthorised reasons as a share of possible sessions."""
    metrics = [(label, pct(c, "sess_possible"), "rate") for label, c in UNAUTHORISED_METRICS]
    return compare_metrics(comparison_rows(df, la1, la2, year, **years), "la_name", la1, la2, metrics)


def compare_verdicts(df: DataFrame, la1: str, la2: str, year, **years) -> DataFrame:
    """One row: which place has the lower overall absence rate and the lower
    share of persistent absentees (a tie goes to the second place), and the
    main absence reason of each."""
    rows = comparison_rows(df, la1, la2, year, **years)
    place = F.col("la_name")
    reason = main_reason()
    return rows.agg(
        F.lit(la1).alias("place1"),
        F.lit(la2).alias("place2"),
        lower_wins("la_name", F.col("sess_overall_percent"), la1, la2).alias("better_attendance"),
        lower_wins("la_name", F.col("enrolments_pa_10_exact_percent"), la1, la2).alias("lower_persistent_absence"),
        F.max(F.when(place == F.lit(la1), reason)).alias("main_reason1"),
        F.max(F.when(place == F.lit(la2), reason)).alias("main_reason2"),
    )


def main_absence_reason(df: DataFrame, year, geographic_level: str = LOCAL_AUTHORITY, by: str = "la_name") -> DataFrame:
    """The largest of the twelve reasons for each place's ``Total`` row in a
    year: (``by``, ``main_reason``). Row-wise, no shuffle."""
    rows = filter_fact(df, year=year, geographic_level=geographic_level, school_type=TOTAL)
    return rows.select(by, main_reason().alias("main_reason"))
