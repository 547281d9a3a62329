"""A stored sort: pages of a large result at any depth from the files they lie in.

The rows are stored in ranges of the sort order, one folder per range, and a
small table beside them says how many rows come before each range. It is written
last, so an index whose writing was lost is not readable. The page at any depth
is then cut from the range, or the few ranges, that hold its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from . import commits

RANGE = "_range"
STARTS_SCHEMA = "first bigint, rows bigint, folder int, value string, keys string"


def _order(value: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{value}`").desc_nulls_last(), *[F.col(f"`{k}`").asc_nulls_last() for k in keys]]


def store_ranked(df: DataFrame, path: str, value: str, keys: Sequence[str], ranges: int) -> str:
    """Store ``df`` sorted by ``value`` descending (null last), then ``keys``
    ascending (null last), in at most ``ranges`` ranges, and return ``path``.

    ``keys`` should make rows unique: rows equal in ``value`` and ``keys`` stay in
    one range, and their order among each other is not defined. A value that a
    third of the rows share is split by the keys. An empty table gives an index
    of no range.
    """
    if ranges < 1:
        raise ValueError("ranges must be positive")
    if RANGE in df.columns:
        raise ValueError(f"a column is named {RANGE}")
    spark, order = df.sparkSession, _order(value, keys)
    # a folder per shuffle partition; the sort writes equal values side by side
    parts = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    parts.withColumn(RANGE, F.spark_partition_id()).write.partitionBy(RANGE).parquet(f"{path}/rows")
    # row counts come from the file footers; the driver holds one number per range
    names = [n for n in commits.names_in(spark, f"{path}/rows") if n.startswith(f"{RANGE}=")]
    counts = {}
    if names:
        stored = spark.read.schema(StructType([*df.schema.fields, StructField(RANGE, IntegerType())])).parquet(f"{path}/rows")
        counts = {r[RANGE]: r["n"] for r in stored.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    starts, first = [], 0
    for number in sorted(counts):
        starts.append((first, counts[number], number, value, "\n".join(keys)))
        first += counts[number]
    spark.createDataFrame(starts or [(0, 0, None, value, "\n".join(keys))], STARTS_SCHEMA).coalesce(1).write.parquet(f"{path}/starts")
    df.limit(0).write.parquet(f"{path}/schema")
    return path


def _starts(spark: SparkSession, path: str) -> DataFrame:
    if not commits.exists(spark, f"{path}/schema/_SUCCESS"):
        raise ValueError(f"no complete index at {path}")
    return spark.read.schema(STARTS_SCHEMA).parquet(f"{path}/starts")


def ranked_rows(spark: SparkSession, path: str) -> int:
    """The number of rows stored, without reading one."""
    return _starts(spark, path).agg(F.sum("rows")).first()[0]


def ranked_page(spark: SparkSession, path: str, page_number: int = 1, page_size: int = 10) -> DataFrame:
    """Rows ``(page_number - 1) * page_size + 1`` … ``page_number * page_size``
    of the stored order, with their ``rank`` (from 1; a column of that name is
    replaced). Only folders that hold rows of the page are read. A page beyond
    the end has no row."""
    if page_number < 1 or page_size < 1:
        raise ValueError("page_number and page_size must be positive")
    before = (page_number - 1) * page_size
    starts = _starts(spark, path)
    value, keys = starts.select("value", "keys").first()
    hit = (F.col("first") < before + page_size) & (F.col("first") + F.col("rows") > before)
    held = sorted((r["first"], r["folder"]) for r in starts.where(hit).toLocalIterator())
    if not held:
        empty = spark.read.parquet(f"{path}/schema")
        return empty.withColumn("rank", F.lit(None).cast("bigint"))
    order = _order(value, keys.split("\n") if keys else [])
    schema = spark.read.parquet(f"{path}/schema").schema
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{RANGE}={n}" for _, n in held])
    page = rows.orderBy(*order).offset(before - held[0][0]).limit(page_size)
    # numbered over the page alone, at most page_size rows
    return page.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint") + F.lit(before))
