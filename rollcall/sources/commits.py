"""Loads and commits of a stored table, shared by the stores of this package.

A load writes its files to folders that end in ``load=<n>``; a commit is a small
Parquet table ``commits/v<n>`` that says which loads make up the table. Spark
writes a table's ``_SUCCESS`` file last, so a commit without one, and the load
before it, is as if it had never been.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def located(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = located(spark, path)
    return fs.exists(p)


def names_in(spark: SparkSession, path: str) -> list[str]:
    p, fs = located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = located(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the complete commits, ascending."""
    found = [n[1:] for n in names_in(spark, f"{table}/commits") if n[:1] == "v" and n[1:].isdigit()]
    return sorted(int(n) for n in found if exists(spark, f"{table}/commits/v{n}/_SUCCESS"))


def committed(spark: SparkSession, table: str, schema: str, version: int | None = None) -> DataFrame:
    """The rows of a commit (the latest)."""
    known = versions(spark, table)
    if not known:
        raise ValueError(f"no complete load at {table}")
    if version is not None and version not in known:
        raise ValueError(f"version {version} is none of {known}")
    return spark.read.schema(schema).parquet(f"{table}/commits/v{known[-1] if version is None else version}")


def loads_in(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[5:]) for n in names_in(spark, folder) if n.startswith("load="))


def next_load(spark: SparkSession, folder: str) -> int:
    """A number that no load in ``folder``, finished or lost, has used."""
    return max(loads_in(spark, folder), default=0) + 1


def commit(spark: SparkSession, table: str, rows: Sequence[tuple], schema: str) -> int:
    """Write the next commit and return its number. Of two writers that commit
    the same number, the second fails; a lost commit's number is passed over."""
    names = [int(n[1:]) for n in names_in(spark, f"{table}/commits") if n[:1] == "v" and n[1:].isdigit()]
    version = max(names, default=0) + 1
    spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(f"{table}/commits/v{version}")
    return version
