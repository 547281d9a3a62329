"""The star schema stored for repeated derivations: order lines and orders
bucketed by order key, so that neither moves again.

Lines are added up to one row per (order, flag, status) before they are stored:
all that the derivation needs, and a bucket never holds more than a few rows of
one order, however many lines it has. Both tables have the same number of
buckets and one file per bucket, so the per-order sums and the join with the
orders read bucket with bucket.

The tables are registered in the session's catalog over files in a folder of
the caller's; :func:`open_star` registers a stored folder in another session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .star import STAR_SCHEMAS, compact_lines

LINES_SCHEMA = "orderkey BIGINT, flag STRING, status STRING, sessions BIGINT, quantity DOUBLE, n_lines BIGINT"
KEYS = {"lines": "orderkey", "orders": "o_orderkey"}
SCHEMAS = {"lines": LINES_SCHEMA, "orders": STAR_SCHEMAS["orders"]}
SMALL_TABLES = ("customer", "nation", "region")


def store_star(tables: dict[str, DataFrame], path: str, buckets: int) -> str:
    """Store the star at ``path`` (which must not exist) and return it.

    One shuffle of partial line sums and one of the orders' four columns, paid
    once per load. Choose ``buckets`` so that a bucket of either table is a
    comfortable task (about stored bytes / 200 MB).
    """
    spark = tables["orders"].sparkSession
    frames = {"lines": compact_lines(tables["lineitem"]), "orders": tables["orders"].select(*[c.split()[0] for c in STAR_SCHEMAS["orders"].split(", ")])}
    for name, df in frames.items():
        table = f"rollcall_store_{uuid.uuid4().hex[:12]}"
        key = KEYS[name]
        # repartitioned as the buckets are, so that each task writes one file
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
         .option("path", f"{path}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")  # external: its files stay
    for name in SMALL_TABLES:
        tables[name].write.parquet(f"{path}/{name}")
    # written last: says how the others are cut
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/layout")
    return path


def open_star(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables at ``path`` for :func:`rollcall.sources.star.derive_fact`:
    ``lines`` in place of ``lineitem``. Each call adds two names that begin
    with ``rollcall_`` to the session's catalog."""
    buckets = spark.read.schema("buckets int").parquet(f"{path}/layout").first()[0]
    out = {name: spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{path}/{name}") for name in SMALL_TABLES}
    for name, key in KEYS.items():
        table = f"rollcall_{name}_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {table} ({SCHEMAS[name]}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}/{name}'")
        out[name] = spark.table(table)
    return out
