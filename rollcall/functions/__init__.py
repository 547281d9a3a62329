"""Column-level building blocks (Spark built-ins only)."""

from .columns import (
    col_of,
    indicator,
    main_reason,
    pct,
    period_in_years,
    period_label,
    period_year,
    year_bounds,
)

__all__ = [
    "col_of",
    "indicator",
    "main_reason",
    "pct",
    "period_in_years",
    "period_label",
    "period_year",
    "year_bounds",
]
