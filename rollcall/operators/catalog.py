"""Dimension catalogs, place search and membership tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def members(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null members of ``column`` (unsorted)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def catalog(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null members of ``column``, sorted."""
    return members(df, column).orderBy(column)


def catalog_size(df: DataFrame, columns: Sequence[str] = ("la_name", "school_type", "region_name")) -> DataFrame:
    """One row: the number of distinct non-null members of each column,
    as ``n_<column>``, from one scan."""
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def search_prefix(
    df: DataFrame,
    prefixes: Sequence[str],
    column: str = "la_name",
    default_rows: int = 10,
) -> DataFrame:
    """Members of ``column`` starting with each prefix, case-blind.

    Returns (``prefix``, ``column``), one row per match: a member matching two
    prefixes appears under both. The prefix is literal text (``%`` and ``_``
    are not wildcards) and is compared in lower case. With no prefixes, the
    first ``default_rows`` members in order, with a null prefix.

    Row-wise: the prefix list is a literal array filtered per member and
    exploded, so there is no join and no shuffle beyond the catalog's distinct.
    """
    if not prefixes:
        return catalog(df, column).limit(default_rows).select(F.lit(None).cast("string").alias("prefix"), column)
    lowered = [p.strip().lower() for p in prefixes]
    name = F.lower(F.col(column))
    matching = F.filter(F.array(*[F.lit(p) for p in lowered]), lambda p: F.startswith(name, p))
    return (
        members(df, column)
        .select(F.explode(F.array_distinct(matching)).alias("prefix"), column)
        .orderBy("prefix", column)
    )


def members_exist(df: DataFrame, values: Sequence[str], column: str = "la_name") -> DataFrame:
    """(``value``, ``present``) for each requested value: whether it occurs in
    ``column``. One filtered aggregate (the ``IN`` list reaches the scan); no
    join."""
    if not values:
        raise ValueError("members_exist needs at least one value")
    c = F.col(column)
    hits = df.where(c.isin(list(values))).agg(
        F.array(
            *[
                F.struct(
                    F.lit(v).alias("value"),
                    F.coalesce(F.max(c == F.lit(v)), F.lit(False)).alias("present"),
                )
                for v in values
            ]
        ).alias("pairs")
    )
    return hits.select(F.inline("pairs"))


def has_any(df: DataFrame, column: str, values: Sequence[str]) -> bool:
    """Whether any of ``values`` occurs in ``column`` (an action). Reads until
    the first match: ``limit(1)`` over the pushed ``IN`` filter."""
    if not values:
        return False
    return df.where(F.col(column).isin(list(values))).limit(1).count() > 0
