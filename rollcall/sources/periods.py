"""A stored fact table whose periods can be replaced one by one.

Every load writes the rows of its periods to a folder of its own, partitioned
by geographic level and period. What the table holds is said by the latest
commit: one row per (level, period) with the load that its rows are in. A commit
is a small table whose ``_SUCCESS`` file is written last, so a load that is lost
before that changes nothing, and a reader sees one load or the next, never
parts of both. No row of another period is read or written by a load.

Rows that repeat a key of the fact table's grain can be kept out: the load then
stores the first row of each key and puts the others beside it.

One writer at a time: of two that commit the same version, the second fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import period_in_years
from ..schema import FACT, FACT_COLUMNS
from . import commits

PARTITIONS = ["geographic_level", "time_period"]
COMMIT_SCHEMA = "geographic_level string, time_period int, load int"


def _partitions(rows: DataFrame) -> list[tuple[str | None, int | None]]:
    """The (level, period) pairs of a table: levels times periods, a few."""
    return sorted((tuple(r) for r in rows.select(*PARTITIONS).distinct().toLocalIterator()), key=repr)


def _one_per_key(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their turn in their key, as (first of each, the others). Keys
    are counted by a partial aggregate; only rows of repeated keys are ranked,
    so a table without any is not shuffled for it."""
    others = [F.col(c) for c in rows.columns if c not in keys]
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    same = [rows[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    marked = repeated.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    single = rows.join(marked, same, "left_anti")
    # equal rows of a key are added up first, so that copies do not meet in one task
    distinct = rows.join(marked, same, "left_semi").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    order = Window.partitionBy(*keys).orderBy(*[c.asc_nulls_last() for c in others])
    ranked = distinct.withColumn("_turn", F.row_number().over(order))
    first = ranked.where(F.col("_turn") == 1).drop("_turn", "_copies")
    extra = F.when(F.col("_turn") == 1, F.col("_copies") - 1).otherwise(F.col("_copies"))
    rest = ranked.select(*rows.columns, extra.alias("copies")).where(F.col("copies") > 0)
    return single.unionByName(first), rest


def replace_periods(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    periods: Sequence[int] | None = None,
    grain: Sequence[str] | None = None,
) -> int:
    """Make the rows of ``df`` the table's rows of ``periods`` and return the
    new version.

    ``periods`` defaults to those that ``df`` has. Rows of ``df`` outside them
    raise an error; a listed period without rows is emptied. With ``grain`` (as
    ``schema.GRAIN``) one row per key is stored, the smallest by its other
    columns, and all others go to :func:`quarantined` with their number of
    copies; without, rows are stored as they are. The rest of the table keeps
    its files.
    """
    df = df.select(*FACT_COLUMNS)
    load = commits.next_load(spark, f"{table}/loads")
    if periods is not None:
        listed = F.coalesce(F.col("time_period").isin(*[int(p) for p in periods]), F.lit(False))
        stray = F.raise_error(F.concat(F.lit("period not in this load: "), F.coalesce(F.col("time_period").cast("string"), F.lit("null"))))
        df = df.withColumn("time_period", F.when(listed, F.col("time_period")).otherwise(stray.cast("int")))
    target = f"{table}/loads/load={load}"
    if grain is None:
        rows = df
    else:
        rows, rest = _one_per_key(df, grain)
        rest.write.parquet(f"{table}/quarantine/load={load}")
    rows.sortWithinPartitions(*PARTITIONS).write.partitionBy(*PARTITIONS).parquet(target)
    made = _partitions(spark.read.schema(FACT).option("basePath", target).parquet(target))
    before = [tuple(r) for r in commits.committed(spark, table, COMMIT_SCHEMA).toLocalIterator()] if commits.versions(spark, table) else []
    gone = {p for _, p in made} if periods is None else {int(p) for p in periods}
    # the marker: one row per (level, period), complete once its _SUCCESS is there
    return commits.commit(spark, table, [r for r in before if r[1] not in gone] + [(*m, load) for m in made], COMMIT_SCHEMA)


def read_periods(spark: SparkSession, table: str, version: int | None = None, years: Sequence[int | str] | None = None,
                 levels: Sequence[str] | None = None) -> DataFrame:
    """The fact table as of a version (the latest): the folders of its
    (level, period) pairs, of these years and levels only if given."""
    state = commits.committed(spark, table, COMMIT_SCHEMA, version)
    if years is not None:
        state = state.where(period_in_years(years))
    if levels is not None:
        state = state.where(F.col("geographic_level").isin(*levels))
    named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString

    def text(value) -> str | None:
        return None if value is None else str(value)

    folders = ["/".join([f"{table}/loads/load={r['load']}", *(named(c, text(r[c])) for c in PARTITIONS)]) for r in state.toLocalIterator()]
    if not folders:
        return spark.createDataFrame([], FACT)
    return spark.read.schema(FACT).option("basePath", f"{table}/loads").parquet(*folders).select(*FACT_COLUMNS)


def quarantined(spark: SparkSession, table: str) -> DataFrame:
    """Rows that loads have kept out: the fact columns, ``copies`` and ``load``."""
    if not commits.exists(spark, f"{table}/quarantine"):
        return spark.createDataFrame([], FACT).withColumns({"copies": F.lit(0).cast("bigint"), "load": F.lit(0)})
    return spark.read.parquet(f"{table}/quarantine")


def drop_unused(spark: SparkSession, table: str, keep: int = 1) -> list[int]:
    """Delete loads that none of the last ``keep`` versions names, lost ones
    too, and older commits. Not while a load or a reader of an old version is
    at work. Returns the deleted loads' numbers."""
    known = commits.versions(spark, table)
    kept = known[-max(1, keep):]
    used = {r["load"] for v in kept for r in commits.committed(spark, table, COMMIT_SCHEMA, v).toLocalIterator()}
    dropped = [n for n in commits.loads_in(spark, f"{table}/loads") if n not in used]
    for n in dropped:
        commits.delete(spark, f"{table}/loads/load={n}")
    for v in set(known) - set(kept):
        commits.delete(spark, f"{table}/commits/v{v}")
    return dropped
