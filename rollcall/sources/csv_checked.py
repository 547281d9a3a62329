"""Published CSV files of different headers, read with rejects instead of
errors: rows that cannot be read are set apart and listed, the rest is loaded."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FACT, FACT_COLUMNS
from . import commits
from .fact_io import SUPPRESSION_MARKERS, number_or_null, store_small

REJECTS_SCHEMA = "file string, row long, column string, text string"


def files_in(spark: SparkSession, path: str) -> list[str]:
    """The data files at ``path`` (a file or a folder), as a scan would list them."""
    p, fs = commits.located(spark, path)
    if not fs.getFileStatus(p).isDirectory():
        return [fs.makeQualified(p).toString()]
    found = [s.getPath() for s in fs.listStatus(p) if not s.isDirectory()]
    return sorted(f.toString() for f in found if f.getName()[:1] not in "_.")


def headers_of(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their header: the first line of each is read, no more. Empty
    files are left out."""
    jvm, out = spark.sparkContext._jvm, defaultdict(list)
    for name in files_in(spark, path):
        p, fs = commits.located(spark, name)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line:
            out[tuple(c.strip() for c in next(csv.reader([line.lstrip("﻿")])))].append(name)
    return dict(out)


def _checked(cell: str, field: T.StructField, markers: Sequence[str]) -> tuple[Column, Column]:
    """(value, text of the cell if it is neither a value nor a marker)."""
    text = F.trim(F.col(f"`{cell}`"))
    if isinstance(field.dataType, T.StringType):
        return F.nullif(text, F.lit("")).alias(field.name), F.lit(None).cast("string")
    number = number_or_null(text, field.dataType)
    empty = text.isNull() | F.lower(text).isin([m.lower() for m in markers])
    value = F.when(~empty, number).alias(field.name)
    return value, F.when(~empty & number.isNull(), text)


def _group(spark: SparkSession, header: tuple[str, ...], files: list[str], markers: Sequence[str]) -> DataFrame:
    """The rows of files of one header: fact columns, other columns as text,
    the bad cells, and where the row is."""
    missing = [c for c in FACT_COLUMNS if c not in header]
    if missing or len(set(header)) < len(header):
        raise ValueError(f"CSV {files[0]}: columns {'missing: ' + str(missing) if missing else 'repeated: ' + str(header)}")
    taken = {h.lower() for h in header}
    broken = next(n for n in ("broken_row", "_broken_row", "__broken_row") if n not in taken)
    schema = T.StructType([T.StructField(h, T.StringType()) for h in (*header, broken)])
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken).csv(files)
    pairs = {f.name: _checked(f.name, f, markers) for f in FACT.fields}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), bad.alias("text")) for c, (_, bad) in pairs.items()])
    whole = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col(f"`{broken}`").alias("text")))
    bad = F.when(F.col(f"`{broken}`").isNotNull(), whole).otherwise(F.filter(cells, lambda x: x["text"].isNotNull()))
    return raw.select(
        *[value for value, _ in pairs.values()], *[F.col(f"`{h}`") for h in header if h not in pairs],
        bad.alias("_bad"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"))


def read_checked(spark: SparkSession, path: str, markers: Sequence[str] = SUPPRESSION_MARKERS) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects) of the CSV file or folder at ``path``.

    Files may differ in the order of their columns and in columns beyond the
    fact table's, which are kept as text and null where a file has none; a file
    that lacks a column of the fact table raises an error. A row with a cell
    that is neither a value of its column nor a marker, or with another number
    of cells than the header, is not accepted. Rejects have a row per bad cell:
    ``file, row, column, text`` (``row``: the row's number in its file, from 1
    below the header; a broken row has no column and its whole text).

    Each file is read once; both results come from the stored outcome. Files
    may be read in several splits: rows are numbered by the counts of the splits
    before theirs. An empty folder raises an error.
    """
    groups = headers_of(spark, path)
    if not groups:
        raise ValueError(f"no CSV rows at {path}")
    frames = [_group(spark, header, files, markers) for header, files in sorted(groups.items())]
    # places of two groups must not meet: each has its number
    numbered = [f.withColumn("_group", F.lit(i)) for i, f in enumerate(frames)]
    rows = store_small(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered), "csv-checked")
    hidden = ["_bad", "_file", "_block", "_place", "_group"]
    accepted = rows.where(F.size("_bad") == 0).drop(*hidden)
    split = ["_group", "_file", "_block"]
    # one row per split of a file; places ascend within a split
    splits = rows.groupBy(*split).agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_group", "_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(*split, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    bad = rows.where(F.size("_bad") > 0).select(*split, "_place", F.explode("_bad").alias("cell"))
    row = F.col("before") + F.col("_place") - F.col("first") + 1
    rejects = bad.join(splits, split).select(F.col("_file").alias("file"), row.alias("row"), "cell.column", "cell.text")
    return accepted, rejects
