"""The generic grouped report: group by any keys, optionally pivot, and take
each field of a named field set (or an ad-hoc mapping)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import GRAIN, field_set


def resolve_fields(fields: str | dict[str, str]) -> dict[str, str]:
    return field_set(fields) if isinstance(fields, str) else dict(fields)


def picks(mapping: dict[str, str], order: Sequence[str]) -> Column:
    """All source fields of ``mapping`` as one struct, taken from the first
    row of the group by ``order``: one buffer for all fields."""
    row = F.struct(*[F.col(f).alias(a) for f, a in mapping.items()])
    return F.min_by(row, F.struct(*[F.col(c) for c in order]))


def pick(field: str, order: Sequence[str]) -> Column:
    """The value of ``field`` on the first row of the group by ``order``.

    A deterministic ``first``: where the grain leaves one row per group (the
    reports' filters ensure that) it is simply that row's value; otherwise the
    row with the smallest ``order`` key wins instead of an arbitrary one. With
    no ordering column left, the largest value (still deterministic).
    """
    if not order:
        return F.max(field)
    return F.min_by(F.col(field), F.struct(*[F.col(c) for c in order]))


def query(
    df: DataFrame,
    *group_by: str,
    fields: str | dict[str, str],
    pivot: str | None = None,
    pivot_values: Sequence | None = None,
    order: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Group ``df`` by ``group_by`` (and pivot on ``pivot``), taking each
    source field under its alias.

    Pass ``pivot_values`` whenever they are known: Spark otherwise runs an
    extra job to find them. With one field, pivot columns are named by the
    value; with several, ``<value>_<alias>``.

    ``unique`` says that each group (and pivot value) has one row, as the
    reports' filters ensure and :func:`check_grain` tests: its value is then
    taken by a plain ``max``, which runs as a hash aggregate.
    """
    mapping = resolve_fields(fields)
    if order is None:
        order = [c for c in GRAIN if c in df.columns and c not in group_by and c != pivot]
    grouped = df.groupBy(*group_by)
    if pivot is not None:
        grouped = grouped.pivot(pivot, list(pivot_values) if pivot_values is not None else None)
    if unique or not order:
        return grouped.agg(*[F.max(f).alias(a) for f, a in mapping.items()])
    if pivot is not None:
        return grouped.agg(*[pick(f, order).alias(a) for f, a in mapping.items()])
    return grouped.agg(picks(mapping, order).alias("_row")).select(*group_by, "_row.*")
