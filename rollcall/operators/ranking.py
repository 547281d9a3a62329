"""Per-group top-k and the grain check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import GRAIN


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[Column],
    k: int,
    rank_column: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of each group by ``order_by``, numbered from 1.

    ``row_number() <= k`` over a partitioned window plans as WindowGroupLimit:
    each task keeps only ``k`` rows per group before the shuffle, so a hot
    group does not travel whole.
    """
    if k < 1:
        raise ValueError("k must be positive")
    w = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(rank_column, F.row_number().over(w)).where(F.col(rank_column) <= k)


def check_grain(df: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Keys that occur more than once, with their count ``n`` (empty when the
    grain holds)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
