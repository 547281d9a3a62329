"""Reading and writing the fact table: CSV in, Parquet at rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FACT, FACT_COLUMNS

PARTITION_COLUMN = "geographic_level"

# Cells of the published tables that stand for "no figure"
# (not available, suppressed, not applicable, low), beside the empty cell.
SUPPRESSION_MARKERS = ("", "x", "c", "z", "k", "u", ":", "..", ".", "-", "~", "low", "n/a", "na", "null")
GROUPED_NUMBER = r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)?$"


def number_or_null(cell: Column, kind: T.DataType) -> Column:
    """The number in trimmed text, null where there is none. Thousands
    separators and, in a count, a zero fraction are accepted (``1,234``, ``12.0``)."""
    plain = F.when(cell.rlike(GROUPED_NUMBER), F.replace(cell, F.lit(","), F.lit(""))).otherwise(cell)
    if isinstance(kind, T.DoubleType):
        return plain.try_cast(kind)
    return F.regexp_replace(plain, r"^([+-]?\d+)\.0*$", "$1").try_cast(kind)


def numeric_cell(name: str, kind: T.DataType, markers: Sequence[str] = SUPPRESSION_MARKERS) -> Column:
    """The number in a text cell. A marker or an empty cell is null; any other
    text that is no number (:func:`number_or_null`) raises an error that names
    column and value."""
    cell = F.trim(F.col(f"`{name}`"))
    bad = F.raise_error(F.concat(F.lit(f"column {name}: not a number or a known marker: "), cell)).cast(kind)
    empty = cell.isNull() | F.lower(cell).isin([m.lower() for m in markers])
    return F.when(empty, F.lit(None).cast(kind)).otherwise(F.coalesce(number_or_null(cell, kind), bad)).alias(name)


def read_fact_csv(
    spark: SparkSession, path: str, extra_columns: bool = True, markers: Sequence[str] = SUPPRESSION_MARKERS
) -> DataFrame:
    """Read the published CSV with a header, under the declared schema.

    Cells are read as text and converted by :func:`numeric_cell`: only the
    listed ``markers`` and empty cells become null. No inference pass over the
    input. In a folder of files every header must equal the first one's: a
    file with other or reordered columns raises an error. Columns the reports
    do not use are kept as text when ``extra_columns`` is set.
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    missing = [c for c in FACT_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"CSV lacks required columns: {missing}")
    typed = [numeric_cell(f.name, f.dataType, markers)
             if not isinstance(f.dataType, T.StringType)
             else F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).alias(f.name)
             for f in FACT.fields]
    rest = [F.col(f"`{c}`") for c in raw.columns if c not in FACT_COLUMNS] if extra_columns else []
    return raw.select(*typed, *rest)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Read the Parquet fact table (partition column restored, schema order
    as declared). Filters on ``geographic_level`` prune directories; filters
    on periods and names reach the row-group statistics."""
    df = spark.read.parquet(path)
    return df.select(*FACT_COLUMNS, *[c for c in df.columns if c not in FACT_COLUMNS])


def write_fact(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (PARTITION_COLUMN,),
    cluster_by: Sequence[str] = ("time_period",),
) -> str:
    """Write the fact table as Parquet, partitioned by geographic level (every
    report but one filters on it) and sorted by period within each write task,
    so row-group statistics let period filters skip row groups (a per-task
    sort, no shuffle). ``mode`` is explicit: ``ignore`` keeps an existing
    table, ``overwrite`` replaces it."""
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def load_fact(spark: SparkSession, parquet_path: str, csv_path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """With ``csv_path``: read the CSV, store it at ``parquet_path`` (``mode``)
    and return the stored table. Without: read ``parquet_path``."""
    if csv_path:
        write_fact(read_fact_csv(spark, csv_path), parquet_path, mode=mode)
    return read_fact(spark, parquet_path)


def stage_fact(spark: SparkSession, df: DataFrame, name: str = "fact") -> DataFrame:
    """Store ``df`` under the shared checkpoint folder and return the stored
    table.

    Cuts the lineage of a long derivation: later reports read compact,
    partitioned Parquet, and a lost executor costs a re-read, not a re-run of
    the joins and aggregates above it.
    """
    from ..session import scratch_path

    return read_fact(spark, write_fact(df, scratch_path(spark, name)))


def write_fact_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write the fact table as CSV with a header (the published layout)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def store_small(df: DataFrame, name: str) -> DataFrame:
    """Store a small intermediate under the shared checkpoint folder and
    return the stored table (not partitioned; the schema is kept)."""
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
