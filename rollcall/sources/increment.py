"""The derivation kept up to date: new orders and lines are merged into stored
sums, without deriving the whole table again.

The state has three parts: lines added up per (order, flag, status), the
orders, and one row of sums per (school, period). A delta may bring new
orders, lines of new orders and late lines of known ones. Whether a pupil is a
persistent absentee depends on all its lines, so the orders that a delta touches
are summed as they were and as they are now, and the difference per (school,
period) is added to the stored sums; no other order is looked at. Schools stay
apart in the state, one row per period, so the number of schools of a place
is a plain count and stays exact; places come from the schools' table
as it is when the fact table is read.

Lines and orders are additive: a delta appends its own to them. The sums per
school are written anew, a small table next to the lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits
from .star import MEASURES, STAR_SCHEMAS, compact_sums, pupils, schools, compact_lines, fact_of_schools
from .star_store import LINES_SCHEMA

COMMIT_SCHEMA = "load int"
#: Stored lines whose orders are summed in one task.
TASK_BYTES = 4 << 20
SUMS = ["pupils", "pa_pupils", *MEASURES]
SCHOOLS_SCHEMA = "school bigint, time_period int, " + ", ".join(f"{c} bigint" for c in SUMS)
ORDER_COLUMNS = [c.split()[0] for c in STAR_SCHEMAS["orders"].split(", ")]


@dataclass
class Sums:
    """The state, or what a delta adds to it."""

    lines: DataFrame
    orders: DataFrame
    schools: DataFrame


def _new_only(orders: DataFrame, known: DataFrame) -> DataFrame:
    """``orders``; one that the state has already raises an error."""
    seen = known.select(F.col("o_orderkey").alias("_key"), F.lit(True).alias("_seen"))
    both = orders.join(seen, F.col("o_orderkey") == F.col("_key"), "left")
    again = F.raise_error(F.concat(F.lit("order is in the table already: "), F.col("o_orderkey").cast("string"))).cast("bigint")
    return both.withColumn("o_orderkey", F.when(F.col("_seen"), again).otherwise(F.col("o_orderkey"))).select(*ORDER_COLUMNS)


def changes(state: Sums, lineitem: DataFrame, orders: DataFrame, parts: int | None = None) -> Sums:
    """What new ``lineitem`` and ``orders`` rows add: their compact lines, the
    orders, and the change of each (school, period)'s sums.

    ``parts``: tasks that the touched orders are summed in (:func:`_parts`). It
    is not left to adaptive execution, which goes by compressed bytes: rows of
    sums are mostly zeros, and take many times that.
    """
    parts = parts or _parts(lineitem.sparkSession, "", [])
    lines = compact_lines(lineitem)
    touched = lines.select("orderkey").union(orders.select("o_orderkey")).where(F.col("orderkey").isNotNull()).distinct()
    old_lines = state.lines.join(touched, "orderkey", "left_semi")
    old_orders = state.orders.join(touched, F.col("o_orderkey") == F.col("orderkey"), "left_semi")
    orders = _new_only(orders.select(*ORDER_COLUMNS), old_orders)
    before = pupils(compact_sums(old_lines.repartition(parts, "orderkey")), old_orders).withColumn("sign", F.lit(-1))
    after = pupils(compact_sums(old_lines.unionByName(lines).repartition(parts, "orderkey")), old_orders.unionByName(orders)).withColumn("sign", F.lit(1))
    moved = before.unionByName(after).groupBy("school", "time_period").agg(
        F.sum("sign").alias("pupils"), F.sum(F.col("sign") * F.col("is_pa")).alias("pa_pupils"),
        *[F.sum(F.col("sign") * F.col(m)).alias(m) for m in MEASURES])
    return Sums(lines, orders, moved)


def merged(schools: DataFrame, change: DataFrame) -> DataFrame:
    """Sums per (school, period) with a change added."""
    both = schools.unionByName(change).groupBy("school", "time_period").agg(*[F.sum(c).alias(c) for c in SUMS])
    return both.where(F.col("pupils") != 0)


def _write(lines: DataFrame, orders: DataFrame, path: str, load: int) -> None:
    lines.write.parquet(f"{path}/lines/load={load}")
    orders.write.parquet(f"{path}/orders/load={load}")


def _loads(spark: SparkSession, path: str, version: int | None) -> list[int]:
    return sorted(r["load"] for r in commits.committed(spark, path, COMMIT_SCHEMA, version).toLocalIterator())


def open_sums(spark: SparkSession, path: str, version: int | None = None) -> Sums:
    """The state as of a version (the latest)."""
    loads = _loads(spark, path, version)

    def table(name: str, schema: str, of: Sequence[int]) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{path}/{name}/load={n}" for n in of])

    return Sums(table("lines", LINES_SCHEMA, loads), table("orders", STAR_SCHEMAS["orders"], loads), table("schools", SCHOOLS_SCHEMA, loads[-1:]))


def _parts(spark: SparkSession, path: str, loads: Sequence[int]) -> int:
    """Tasks for the lines of ``loads``: one for each ``TASK_BYTES`` of their
    files, and more than the number of shuffle partitions (Spark drops a
    repartition of rows that are dealt to the same number already)."""
    stored = 0
    for n in loads:
        p, fs = commits.located(spark, f"{path}/lines/load={n}")
        stored += fs.getContentSummary(p).getLength()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")) + 1, -(-stored // TASK_BYTES))


def create(tables: dict[str, DataFrame], path: str) -> int:
    """Store the state of a whole star at ``path``; returns version 1."""
    spark = tables["orders"].sparkSession
    if commits.versions(spark, path):
        raise ValueError(f"{path} holds a state already")
    load = commits.next_load(spark, f"{path}/lines")
    _write(compact_lines(tables["lineitem"]), tables["orders"].select(*ORDER_COLUMNS), path, load)
    # from the stored lines: the raw ones are read once
    stored = spark.read.schema(LINES_SCHEMA).parquet(f"{path}/lines/load={load}")
    orders = spark.read.schema(STAR_SCHEMAS["orders"]).parquet(f"{path}/orders/load={load}")
    schools(pupils(compact_sums(stored), orders)).write.parquet(f"{path}/schools/load={load}")
    return commits.commit(spark, path, [(load,)], COMMIT_SCHEMA)


def add(spark: SparkSession, path: str, lineitem: DataFrame, orders: DataFrame) -> int:
    """Merge new rows into the state at ``path``; returns the new version.

    ``orders``: orders that the state does not have (one that it has raises an
    error). ``lineitem``: lines not yet merged, of new or known orders; lines
    without an order wait for it. Either may be empty. A load that is lost
    before its commit changes nothing and can be run again.
    """
    loads = _loads(spark, path, None)
    state = open_sums(spark, path)
    load = commits.next_load(spark, f"{path}/lines")
    change = changes(state, lineitem, orders, _parts(spark, path, loads))
    _write(change.lines, change.orders, path, load)
    merged(state.schools, change.schools).write.parquet(f"{path}/schools/load={load}")
    return commits.commit(spark, path, [(n,) for n in (*loads, load)], COMMIT_SCHEMA)


def compact(spark: SparkSession, path: str) -> int:
    """Rewrite the appended lines and orders as one load, so that reads of many
    small deltas stay cheap; returns the new version. Results are the same."""
    state = open_sums(spark, path)
    load = commits.next_load(spark, f"{path}/lines")
    together = state.lines.groupBy("orderkey", "flag", "status").agg(*[F.sum(c).alias(c) for c in ("sessions", "quantity", "n_lines")])
    _write(together, state.orders, path, load)
    state.schools.write.parquet(f"{path}/schools/load={load}")
    return commits.commit(spark, path, [(load,)], COMMIT_SCHEMA)


def fact(spark: SparkSession, path: str, tables: dict[str, DataFrame], version: int | None = None, levels: Sequence[str] | None = None,
         school_types: Sequence[str] | None = None) -> DataFrame:
    """The fact table of the state, with places from ``customer``, ``nation``
    and ``region`` of ``tables``."""
    return fact_of_schools(open_sums(spark, path, version).schools, tables, levels, school_types)
