"""Joins to dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact side to a dimension side. No hint and no count: the
    planner's byte estimate, and AQE's measured bytes at run time, decide
    whether the dimension is broadcast (``spark.sql.autoBroadcastJoinThreshold``)."""
    return fact.join(dim, on, how)
