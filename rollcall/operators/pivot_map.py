"""A pivot without column names: one map per row, for any number of values.

Spark's ``pivot`` needs its values before it can plan, so it runs a job to find
them and refuses more than ``spark.sql.pivotMaxValues``. Here they are collected
by the aggregate that takes the cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouped import resolve_fields


def pivot_map(df: DataFrame, *group_by: str, pivot: str, fields: str | dict[str, str]) -> DataFrame:
    """``group_by``, ``cells`` (map from each value of ``pivot`` in the group to a
    struct of the fields under their aliases) and ``cell_of_null`` (the struct
    of rows whose pivot value is null; null without such rows).

    Each cell takes the largest value of a field, as ``query(unique=True)`` does.
    Cells are added up per (group, value) first, with a map-side partial
    aggregate, so what meets in a group is one entry per value and not its rows.
    Keys of the map ascend. An empty table gives an empty result; without
    ``group_by`` there is one row.
    """
    mapping = resolve_fields(fields)
    cells = df.groupBy(*group_by, F.col(pivot).alias("_value")).agg(*[F.max(f).alias(f"_{a}") for f, a in mapping.items()])
    cell = F.struct(*[F.col(f"_{a}").alias(a) for a in mapping.values()])
    known = F.col("_value").isNotNull()
    entries = F.sort_array(F.collect_list(F.when(known, F.struct(F.col("_value").alias("key"), cell.alias("value")))))
    return cells.groupBy(*group_by).agg(
        F.map_from_entries(entries).alias("cells"), F.max(F.when(~known, cell)).alias("cell_of_null")
    )


def map_columns(wide: DataFrame, values: Sequence, aliases: Sequence[str]) -> DataFrame:
    """A pivot's columns for some ``values`` from :func:`pivot_map`'s result,
    named as ``query`` names them: by the value for one alias, else
    ``<value>_<alias>``."""
    keys = [c for c in wide.columns if c not in ("cells", "cell_of_null")]
    named = [(v, a, f"{v}" if len(aliases) == 1 else f"{v}_{a}") for v in values for a in aliases]
    return wide.select(*keys, *[F.try_element_at("cells", F.lit(v)).getField(a).alias(n) for v, a, n in named])


def map_cells(wide: DataFrame, pivot: str) -> DataFrame:
    """The cells of :func:`pivot_map`'s result as rows again, the value of a
    cell under ``pivot`` (null for ``cell_of_null``)."""
    keys = [c for c in wide.columns if c not in ("cells", "cell_of_null")]
    listed = wide.select(*keys, F.explode("cells").alias(pivot, "_cell"))
    kind = dict(listed.dtypes)[pivot]
    rest = wide.where(F.col("cell_of_null").isNotNull()).select(*keys, F.lit(None).cast(kind).alias(pivot), F.col("cell_of_null").alias("_cell"))
    return listed.unionByName(rest).select(*keys, pivot, "_cell.*")
