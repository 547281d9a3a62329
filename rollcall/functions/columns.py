"""Column expressions shared by the operators. All are Spark built-ins, so
they compile into whole-stage code and never leave the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MAIN_REASONS


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(value: str | Column, total: str | Column) -> Column:
    """``value / total * 100``; a zero or null denominator or a null value gives 0.0."""
    ratio = F.try_divide(col_of(value).cast("double"), col_of(total).cast("double"))
    return F.coalesce(ratio * F.lit(100.0), F.lit(0.0))


def year_bounds(year: int | str) -> tuple[int, int]:
    """Inclusive period bounds for an academic year given by its start year.

    Periods are six-digit integers ``YYYYyy`` (``201819`` starts in 2018), so a
    year prefix is the integer range ``[YYYY00, YYYY99]``. A range, unlike a
    text prefix on the integer, is pushed into the Parquet scan.
    """
    text = str(year).strip()
    if not text.isdigit() or len(text) != 4:
        raise ValueError(f"year must be four digits, got {year!r}")
    y = int(text)
    return y * 100, y * 100 + 99


def period_in_years(years: int | str | Iterable[int | str], column: str = "time_period") -> Column:
    """True where the period starts in any of ``years`` (OR of ranges).

    An empty collection selects nothing.
    """
    if isinstance(years, (int, str)):
        years = [years]
    cond: Column | None = None
    for y in years:
        lo, hi = year_bounds(y)
        c = F.col(column).between(lo, hi)
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)


def period_year(column: str | Column = "time_period") -> Column:
    """Start year of a six-digit period: ``201819 -> 2018``."""
    return F.floor(col_of(column) / 100).cast("int")


def period_label(period: int | str) -> str:
    """Display label of a period column name: drop the last two characters."""
    return str(period)[:-2]


def indicator(value1: Column, value2: Column, kind: Column) -> Column:
    """``better``/``worse``/``same`` where ``kind`` is ``rate`` (lower is
    better) or ``reverse`` (higher is better); null for counts or when a value
    is missing."""
    diff = F.when(kind == F.lit("reverse"), value2 - value1).otherwise(value1 - value2)
    return (
        F.when(~kind.isin("rate", "reverse"), F.lit(None).cast("string"))
        .when(diff == 0, F.lit("same"))
        .when(diff < 0, F.lit("better"))
        .when(diff > 0, F.lit("worse"))
    )


def main_reason(reasons: Sequence[tuple[str, str]] = MAIN_REASONS) -> Column:
    """Label of the largest reason column in each row; ties go to the earlier
    reason, nulls are ignored, all-null gives null.

    Row-wise: ``array_max`` over (sessions, -position, label) structs, so there is
    no unpivot, no shuffle and no aggregate.
    """
    entries = F.array(
        *[
            F.struct(
                F.col(column).cast("long").alias("sessions"),
                F.lit(-i).alias("neg_position"),
                F.lit(label).alias("label"),
            )
            for i, (label, column) in enumerate(reasons)
        ]
    )
    present = F.filter(entries, lambda e: e["sessions"].isNotNull())
    return F.array_max(present)["label"]
