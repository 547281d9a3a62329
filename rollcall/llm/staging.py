"""Intermediate tables in the shared folder, and small column helpers."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a re-read of the stored table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name built on ``stem`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def uniform(*parts: Column | int) -> Column:
    """A repeatable pseudo-random double strictly between 0 and 1."""
    cols = [F.lit(p) if isinstance(p, int) else p for p in parts]
    top = F.shiftrightunsigned(F.xxhash64(*cols), 12)
    return (top.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


#: A group is large if it has more than this share of all rows.
LARGE_SHARE = 1e-3


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row per value of
    ``keys`` (no nulls) and in ``size`` the number of ``rows`` that share it.

    Groups with more than ``LARGE_SHARE`` of all rows (at most 1 / share of
    them) are broadcast and their rows stay where they are; only the others are
    dealt by key. So no group, however large, meets in one task.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    values = [c for c in groups.columns if c not in keys]
    large, rest, away = (free_name(rows, n) for n in ("group_large", "group_rest", "group_away"))
    many = F.col(size) > max(1000, total * LARGE_SHARE)
    found = rows.join(F.broadcast(groups.where(many).select(*keys, F.struct(*values).alias(large))), keys, "left")
    # rows that have their group already look for a key that is nobody's
    found = found.withColumn(away, F.when(F.col(large).isNotNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    others = groups.where(~many).select(*keys, F.lit(-1).cast("bigint").alias(away), F.struct(*values).alias(rest))
    out = found.join(others, [*keys, away], "left")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.coalesce(F.col(f"{large}.{v}"), F.col(f"{rest}.{v}")).alias(v) for v in values])


def give_back() -> None:
    """Return memory that Arrow's pool has kept of freed arrays to the system: a
    Python worker stays for later tasks and stages beside others of its executor."""
    pa.default_memory_pool().release_unused()


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker process. (Functions
    here are pickled by value, so their module globals last for one task.)"""
    name = "_rollcall_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("state", {})
