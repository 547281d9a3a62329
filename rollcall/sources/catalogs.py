"""Catalogs kept beside a stored fact table, added up instead of read anew.

For every load of a table stored by periods, the members of each catalog column
and their rows are counted per (level, period), and a sketch of them is kept.
What the table holds is said by its commit, so the catalog of a version is the
sum of the entries that the commit names: a replaced period takes its members
with it, and no row of the table is read. Exact catalogs and sizes add up
counts; approximate sizes unite the sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FACT
from . import commits
from .periods import COMMIT_SCHEMA, PARTITIONS

COLUMNS = ("la_name", "school_type", "region_name")
LG_K = 12  # about 1.6 % standard error of a sketch, 4 kB at most


def _loads(spark: SparkSession, table: str, version: int | None) -> list[int]:
    state = commits.committed(spark, table, COMMIT_SCHEMA, version)
    return sorted(r["load"] for r in state.select("load").distinct().toLocalIterator())


def _complete(spark: SparkSession, table: str, load: int) -> bool:
    # the sketches are written last
    return commits.exists(spark, f"{table}/catalogs/sketches/load={load}/_SUCCESS")


def refresh_catalogs(spark: SparkSession, table: str, columns: Sequence[str] = COLUMNS) -> list[int]:
    """Count the loads that the latest version names and that have no catalog
    yet, and return their numbers. Run it after each load; a run that was lost
    is made up for by the next. All runs for a table must name the same columns."""
    made = []
    for load in _loads(spark, table, None):
        if _complete(spark, table, load):
            continue
        path = f"{table}/loads/load={load}"
        rows = spark.read.schema(FACT).option("basePath", path).parquet(path)
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("member")) for c in columns])
        counted = rows.select(*PARTITIONS, F.inline(pairs)).where(F.col("member").isNotNull())
        counted = counted.groupBy(*PARTITIONS, "column", "member").agg(F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{table}/catalogs/members/load={load}")
        sketches = rows.groupBy(*PARTITIONS).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(c) for c in columns])
        sketches.write.mode("overwrite").parquet(f"{table}/catalogs/sketches/load={load}")
        made.append(load)
    return made


def _entries(spark: SparkSession, table: str, kind: str, version: int | None) -> DataFrame | None:
    """The rows of ``kind`` that belong to a version; None for an empty table."""
    loads = _loads(spark, table, version)
    missing = [n for n in loads if not _complete(spark, table, n)]
    if missing:
        raise ValueError(f"loads {missing} have no catalog: call refresh_catalogs")
    if not loads:
        return None
    folders = [f"{table}/catalogs/{kind}/load={n}" for n in loads]
    rows = spark.read.option("basePath", f"{table}/catalogs/{kind}").parquet(*folders)
    state = commits.committed(spark, table, COMMIT_SCHEMA, version).select(*[F.col(c).alias(f"_{c}") for c in (*PARTITIONS, "load")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*PARTITIONS, "load")]
    return rows.join(state, same, "left_semi")


def stored_catalog(spark: SparkSession, table: str, column: str, version: int | None = None) -> DataFrame:
    """Members of ``column`` in a version (the latest) and their ``rows``, sorted."""
    found = _entries(spark, table, "members", version)
    if found is None:
        return spark.createDataFrame([], f"`{column}` string, rows bigint")
    own = found.where(F.col("column") == column).groupBy(F.col("member").alias(column))
    return own.agg(F.sum("rows").alias("rows")).orderBy(column)


def stored_sizes(spark: SparkSession, table: str, columns: Sequence[str] = COLUMNS, version: int | None = None) -> DataFrame:
    """One row, ``n_<column>``: the exact number of members of each column."""
    found = _entries(spark, table, "members", version)
    if found is None:
        return spark.range(1).select(*[F.lit(0).cast("bigint").alias(f"n_{c}") for c in columns])
    distinct = found.groupBy("column", "member").agg(F.lit(1).alias("one"))
    return distinct.agg(*[F.count_if(F.col("column") == c).alias(f"n_{c}") for c in columns])


def stored_sizes_approx(spark: SparkSession, table: str, columns: Sequence[str] = COLUMNS, version: int | None = None) -> DataFrame:
    """As :func:`stored_sizes`, estimated from the sketches: one small row per
    (level, period) is read, whatever the number of members."""
    found = _entries(spark, table, "sketches", version)
    if found is None:
        return spark.range(1).select(*[F.lit(0).cast("bigint").alias(f"n_{c}") for c in columns])
    sizes = [F.hll_sketch_estimate(F.hll_union_agg(c)) for c in columns]
    return found.agg(*[F.coalesce(s, F.lit(0)).cast("bigint").alias(f"n_{c}") for c, s in zip(columns, sizes, strict=True)])
