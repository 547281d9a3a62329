"""Derive the attendance fact table from the TPC-H-style star schema.

Mapping (the test-data convention): order = pupil, customer = school, line
quantity = sessions, return flag ``A`` = authorised absence, ``R`` =
unauthorised absence, nation = local authority, region = region, market
segment = school type, order year + 17 = start of the academic year. Reasons
come from the order-priority digit and the line status. A pupil is a
persistent absentee when absent for at least 80 % of its sessions.

Plan, written for a lineitem table of many terabytes:

1. ``lineitem`` (four columns read) is reduced to one row per order (seven
   sums), with a partial aggregate on the map side, so the shuffle carries at
   most one row per order per map task. The persistent-absence test needs
   whole-order totals, and this aggregate provides them without a window over
   the raw lines.
2. That result is already hash-partitioned by order key, so the 1:1 join to
   ``orders`` shuffles only ``orders``.
3. Pupils are summed to one row per (school, period). A hot school (one
   customer with a third of all orders) collapses in the partial aggregate, so
   no task receives its raw rows. (The 24 measures are mostly zero per row and
   compress well: a variant shuffling five sums per (school, period, priority,
   flag) measured 60 % more shuffle bytes; see tools/shuffle_bytes.py.)
4. Only then is ``customer`` joined: each school has at most one row per
   period, so the join cannot be skewed. The ``nation`` x ``region``
   geography joins the customer scan; the planner broadcasts it by its bytes.
5. One aggregate to the finest grain (period, region, LA, school type): a
   school row is unique per (school, period), so distinct counts become
   ``count(*)`` and sums of pupil counts, which combine map-side. No
   ``count(DISTINCT)``.
6. The six grouping sets (national, by type, by region, by region and type,
   by LA, by LA and type) roll up from that small table, so the Expand that
   grouping sets need never touches the large rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import year_bounds
from ..operators.joins import join_dimension
from ..schema import FACT_COLUMNS, LEVELS, LOCAL_AUTHORITY, NATIONAL, REGIONAL, TOTAL

# ---------------------------------------------------------------------------
# Fixed values of the test-data mapping.
# ---------------------------------------------------------------------------
PRIMARY_SEGMENTS = ["AUTOMOBILE", "HOUSEHOLD"]
SECONDARY_SEGMENTS = ["BUILDING", "MACHINERY"]
YEAR_OFFSET = 17
# Persistent absentee: absent sessions * 10 >= possible sessions * 8.
PA_NUMERATOR, PA_DENOMINATOR = 10, 8
# Reason code = priority digit + line status. Authorised (flag A) reasons:
AUTH_REASON_CODES = {
    "sess_auth_illness": ["1F", "1O"],
    "sess_auth_appointments": ["2F"],
    "sess_auth_religious": ["2O"],
    "sess_auth_study": ["3F"],
    "sess_auth_traveller": ["3O"],
    "sess_auth_holiday": ["4F"],
    "sess_auth_ext_holiday": ["4O"],
    "sess_auth_excluded": ["5F"],
    "sess_auth_other": ["5O"],
}
# Unauthorised (flag R) reasons:
UNAUTH_REASON_CODES = {
    "sess_unauth_late": ["1F", "1O"],
    "sess_unauth_holiday": ["2F", "2O"],
    "sess_unauth_other": ["3F", "3O", "5F", "5O"],
    "sess_unauth_noyet": ["4F", "4O"],
}

# Declared read schemas: only the columns the mapping uses. A declared schema
# skips the footer-reading job of schema discovery, and the scan reads only
# these columns.
STAR_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_quantity DOUBLE, l_returnflag STRING, l_linestatus STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}
TABLES = tuple(STAR_SCHEMAS)


def read_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.schema(STAR_SCHEMAS[t]).parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def compact_lines(lineitem: DataFrame) -> DataFrame:
    """Lines added up per (order, flag, status): all that the derivation uses
    of them, additive over any parts of the lines. Only four columns are read."""
    q = F.col("l_quantity")
    return lineitem.groupBy(F.col("l_orderkey").alias("orderkey"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(
        F.sum(q.cast("bigint")).alias("sessions"), F.sum(q).alias("quantity"), F.count(F.lit(1)).alias("n_lines"))


def _sums(key: Column, flag: Column, status: Column, sessions: Column, quantity: Column, rows: DataFrame) -> DataFrame:
    def part(f: str, s: str) -> Column:
        return F.sum(F.when((flag == f) & (status == s), sessions).otherwise(F.lit(0))).alias(f"q_{f}{s}")

    absent_qty = F.when(flag.isin("A", "R"), quantity).otherwise(F.lit(0.0))
    return rows.groupBy(key.alias("orderkey")).agg(
        F.sum(sessions).alias("q_all"),
        part("A", "F"),
        part("A", "O"),
        part("R", "F"),
        part("R", "O"),
        F.sum(absent_qty).alias("qty_absent"),
        F.sum(quantity).alias("qty_all"),
    )


def _line_sums(lineitem: DataFrame) -> DataFrame:
    """One row per order: sessions by (flag, line status) plus the totals the
    persistent-absence test compares. Only four columns are read."""
    q = F.col("l_quantity")
    return _sums(F.col("l_orderkey"), F.col("l_returnflag"), F.col("l_linestatus"), q.cast("bigint"), q, lineitem)


def compact_sums(lines: DataFrame) -> DataFrame:
    """As :func:`_line_sums`, of :func:`compact_lines`."""
    return _sums(*[F.col(c) for c in ("orderkey", "flag", "status", "sessions", "quantity")], lines)


def pupils(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per pupil (order) with period, school and all session measures."""
    o = orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("school"),
        F.year("o_orderdate").alias("y"),
        F.substring("o_orderpriority", 1, 1).alias("digit"),
    )
    p = lines.join(o, "orderkey")
    digit = F.col("digit")
    auth = F.col("q_AF") + F.col("q_AO")
    unauth = F.col("q_RF") + F.col("q_RO")
    pa = (F.col("qty_absent") * PA_NUMERATOR) >= (F.col("qty_all") * PA_DENOMINATOR)

    def coded(flag: str, codes: list[str]) -> Column:
        # Sessions of this flag whose reason code is in ``codes``.
        terms = [F.when(digit == c[0], F.col(f"q_{flag}{c[1]}")).otherwise(F.lit(0)) for c in codes]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def when_pa(c: Column) -> Column:
        return F.when(pa, c).otherwise(F.lit(0))

    measures = {
        "sess_possible": F.col("q_all"),
        "sess_overall": auth + unauth,
        "sess_authorised": auth,
        "sess_unauthorised": unauth,
        "sess_possible_pa_10_exact": when_pa(F.col("q_all")),
        "sess_overall_pa_10_exact": when_pa(auth + unauth),
        "sess_authorised_pa_10_exact": when_pa(auth),
        "sess_unauthorised_pa_10_exact": when_pa(unauth),
    }
    measures.update({name: coded("A", codes) for name, codes in AUTH_REASON_CODES.items()})
    measures.update({name: coded("R", codes) for name, codes in UNAUTH_REASON_CODES.items()})

    period = ((F.col("y") + YEAR_OFFSET) * 100 + (F.col("y") + YEAR_OFFSET + 1) % 100).cast("int")
    return p.select(
        "school",
        period.alias("time_period"),
        F.when(pa, F.lit(1)).otherwise(F.lit(0)).alias("is_pa"),
        *[c.alias(n) for n, c in measures.items()],
    )


MEASURES = [
    "sess_possible", "sess_overall", "sess_authorised", "sess_unauthorised",
    "sess_possible_pa_10_exact", "sess_overall_pa_10_exact",
    "sess_authorised_pa_10_exact", "sess_unauthorised_pa_10_exact",
    *AUTH_REASON_CODES, *UNAUTH_REASON_CODES,
]


def schools(pupils: DataFrame) -> DataFrame:
    """One row per (school, period): pupil counts and session sums."""
    return pupils.groupBy("school", "time_period").agg(
        F.count(F.lit(1)).alias("pupils"),
        F.sum("is_pa").alias("pa_pupils"),
        *[F.sum(m).alias(m) for m in MEASURES],
    )


def _places(tables: dict[str, DataFrame]) -> DataFrame:
    """School -> (region, LA, school type): customer with its geography."""
    geo = (
        tables["nation"]
        .select(
            F.col("n_nationkey").alias("nationkey"),
            F.col("n_name").alias("la_name"),
            F.col("n_regionkey").alias("regionkey"),
        )
        .join(
            tables["region"].select(F.col("r_regionkey").alias("regionkey"), F.col("r_name").alias("region_name")),
            "regionkey",
        )
        .drop("regionkey")
    )
    seg = F.col("c_mktsegment")
    school_type = (
        F.when(seg.isin(*PRIMARY_SEGMENTS), F.lit("State-funded primary"))
        .when(seg.isin(*SECONDARY_SEGMENTS), F.lit("State-funded secondary"))
        .otherwise(F.lit("Special"))
    )
    cust = tables["customer"].select(
        F.col("c_custkey").alias("school"),
        F.col("c_nationkey").alias("nationkey"),
        school_type.alias("school_type"),
    )
    return join_dimension(cust, geo, "nationkey").drop("nationkey")


def orders_of(orders: DataFrame, years: Sequence[int | str]) -> DataFrame:
    """Orders whose period starts in one of ``years``: ranges of
    ``o_orderdate``, which reach the Parquet scan."""
    starts = [year_bounds(y)[0] // 100 - YEAR_OFFSET for y in years]
    date = F.col("o_orderdate")
    ranges = [(date >= F.lit(f"{y:04d}-01-01").cast("timestamp_ntz")) & (date < F.lit(f"{y + 1:04d}-01-01").cast("timestamp_ntz"))
              for y in starts]
    return orders.where(reduce(lambda a, b: a | b, ranges, F.lit(False)))


# Grouping sets by (geographic level, whether school types are kept apart).
GROUPING_SETS = {
    (NATIONAL, False): ["time_period"],
    (NATIONAL, True): ["time_period", "school_type"],
    (REGIONAL, False): ["time_period", "region_name"],
    (REGIONAL, True): ["time_period", "region_name", "school_type"],
    (LOCAL_AUTHORITY, False): ["time_period", "region_name", "la_name"],
    (LOCAL_AUTHORITY, True): ["time_period", "region_name", "la_name", "school_type"],
}


def grouping_sets(levels: Sequence[str] | None, school_types: Sequence[str] | None) -> list[list[str]]:
    """The grouping sets that rows of the given levels and types come from."""
    unknown = set(levels or []) - set(LEVELS)
    if unknown:
        raise ValueError(f"unknown geographic levels: {sorted(unknown)}")
    return [
        keys for (level, by_type), keys in GROUPING_SETS.items()
        if (levels is None or level in levels)
        and (school_types is None or (any(t != TOTAL for t in school_types) if by_type else TOTAL in school_types))
    ]


def derive_fact(
    tables: dict[str, DataFrame],
    years: Sequence[int | str] | None = None,
    levels: Sequence[str] | None = None,
    school_types: Sequence[str] | None = None,
) -> DataFrame:
    """The 39-column fact table at all six grains, from the star schema.

    ``years``, ``levels`` and ``school_types`` say which rows a report needs:
    years become a range of ``o_orderdate`` in the orders scan, and the join
    keeps their per-order sums (lines are never shuffled before they are added
    up, so an order of any size is one row per map task); levels and types
    leave only the grouping sets they come from (a set keeps all its types).
    ``None`` keeps all.
    """
    orders = tables["orders"] if years is None else orders_of(tables["orders"], years)
    # a stored star (star_store) has lines added up and bucketed by order
    lines = compact_sums(tables["lines"]) if "lines" in tables else _line_sums(tables["lineitem"])
    return fact_of_schools(schools(pupils(lines, orders)), tables, levels, school_types)


def fact_of_schools(
    schools: DataFrame,
    tables: dict[str, DataFrame],
    levels: Sequence[str] | None = None,
    school_types: Sequence[str] | None = None,
) -> DataFrame:
    """The fact table from one row per (school, period), with the places of
    the schools from ``tables``."""
    sets = grouping_sets(levels, school_types)
    if not sets:
        raise ValueError("no rows of the fact table are of these levels and school types")
    placed = schools.join(_places(tables), "school")
    keys = ["time_period", "region_name", "la_name", "school_type"]

    # Finest grain (LA x type): the only aggregate over large data. A school
    # row is unique per (school, period), so schools count with count(*).
    finest = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_schools"),
        F.sum("pupils").alias("enrolments"),
        F.sum("pa_pupils").alias("enrolments_pa_10_exact"),
        *[F.sum(m).alias(m) for m in MEASURES],
    )

    def total(c: str, alias: str | None = None) -> Column:
        return F.sum(c).cast("bigint").alias(alias or c)

    # Every measure is additive, so the coarser grains roll up from the small
    # finest-grain table: the grouping-set Expand never sees the large rows.
    cube = finest.groupingSets(sets, *keys).agg(
        F.grouping("region_name").alias("g_region"),
        F.grouping("la_name").alias("g_la"),
        F.grouping("school_type").alias("g_type"),
        total("num_schools"),
        total("enrolments"),
        total("enrolments_pa_10_exact"),
        total("sess_possible"),
        total("sess_overall"),
        total("sess_authorised"),
        total("sess_unauthorised"),
        total("sess_overall", "sess_overall_totalreasons"),
        total("sess_authorised", "sess_auth_totalreasons"),
        total("sess_unauthorised", "sess_unauth_totalreasons"),
        total("sess_possible_pa_10_exact"),
        total("sess_overall_pa_10_exact"),
        total("sess_authorised_pa_10_exact"),
        total("sess_unauthorised_pa_10_exact"),
        *[total(c) for c in AUTH_REASON_CODES],
        *[total(c) for c in UNAUTH_REASON_CODES],
    )

    level = (
        F.when(F.col("g_region") == 1, F.lit("National"))
        .when(F.col("g_la") == 1, F.lit("Regional"))
        .otherwise(F.lit("Local authority"))
    )

    def rate(num: str, den: Column) -> Column:
        # 100 * num / den; a zero denominator gives null (not an error under ANSI).
        return F.try_divide(F.lit(100.0) * F.col(num).cast("double"), den)

    possible = F.col("sess_possible")
    possible_pa = F.nullif(F.col("sess_possible_pa_10_exact"), F.lit(0))
    computed = {
        "geographic_level": level,
        "school_type": F.when(F.col("g_type") == 1, F.lit("Total")).otherwise(F.col("school_type")),
        "enrolments_pa_10_exact_percent": rate("enrolments_pa_10_exact", F.col("enrolments")),
        "sess_overall_percent": rate("sess_overall", possible),
        "sess_authorised_percent": rate("sess_authorised", possible),
        "sess_unauthorised_percent": rate("sess_unauthorised", possible),
        "sess_overall_percent_pa_10_exact": rate("sess_overall_pa_10_exact", possible_pa),
        "sess_authorised_percent_pa_10_exact": rate("sess_authorised_pa_10_exact", possible_pa),
        "sess_unauthorised_percent_pa_10_exact": rate("sess_unauthorised_pa_10_exact", possible_pa),
    }
    return cube.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in FACT_COLUMNS])


def absence(
    spark: SparkSession,
    sf_dir: str,
    years: Sequence[int | str] | None = None,
    levels: Sequence[str] | None = None,
    school_types: Sequence[str] | None = None,
) -> DataFrame:
    """The fact table derived from the star-schema Parquet files in
    ``sf_dir``; the other arguments as for :func:`derive_fact`."""
    return derive_fact(read_star(spark, sf_dir), years, levels, school_types)
