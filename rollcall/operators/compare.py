"""Side-by-side comparison of two places as a long DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import indicator

# A metric: (label, value expression over one fact row, kind "rate", "reverse"
# (higher is better) or "count").
Metric = tuple[str, Column, str]


def compare_metrics(
    df: DataFrame,
    place_column: str,
    place1: str,
    place2: str,
    metrics: Sequence[Metric],
) -> DataFrame:
    """One row per metric: ``metric_order, metric, kind, value1, value2, diff,
    indicator``.

    ``df`` holds at most one row per place (filter it to one period and one
    grain first). Values are doubles. ``indicator`` is ``better`` when the
    first place's rate is lower (for kind ``reverse``: higher), ``worse`` when
    higher, ``same`` when equal, and null for counts or a missing value.

    One global aggregate picks each place's value (at most two input rows),
    then the metrics are exploded row-wise: no join, no per-metric job.
    """
    place = F.col(place_column)

    def value_of(p: str, expr: Column) -> Column:
        return F.max(F.when(place == F.lit(p), expr.cast("double")))

    pairs = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("metric_order"),
                F.lit(label).alias("metric"),
                F.lit(kind).alias("kind"),
                value_of(place1, expr).alias("value1"),
                value_of(place2, expr).alias("value2"),
            )
            for i, (label, expr, kind) in enumerate(metrics)
        ]
    )
    rows = df.where(place.isin(place1, place2)).agg(pairs.alias("pairs")).select(F.inline("pairs"))
    return rows.select(
        "metric_order",
        "metric",
        "kind",
        "value1",
        "value2",
        (F.col("value1") - F.col("value2")).alias("diff"),
        indicator(F.col("value1"), F.col("value2"), F.col("kind")).alias("indicator"),
    )


def lower_wins(place_column: str, value: Column, place1: str, place2: str) -> Column:
    """Aggregate: ``place1`` when its value is strictly lower than ``place2``'s,
    else ``place2`` (a tie goes to the second place); null if either is missing."""
    place = F.col(place_column)
    v1 = F.max(F.when(place == F.lit(place1), value))
    v2 = F.max(F.when(place == F.lit(place2), value))
    return F.when(v1 < v2, F.lit(place1)).when(v1 >= v2, F.lit(place2))
