"""School type x region in one year: rates, per-type rankings, type means,
regional ranges, consistency and the key findings.

Everything derives from :func:`region_type_rates` (one row per region and
type). Instead of a loop over types and regions with a job per cell, each
result is one grouped aggregate or one partitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import filter_fact, filter_year, top_k_per_group
from ..schema import REGIONAL, SCHOOL_TYPES, TOTAL

RATE_NAMES = {
    "sess_overall_percent": "overall_absence_rate",
    "sess_authorised_percent": "authorised_absence_rate",
    "sess_unauthorised_percent": "unauthorised_absence_rate",
}
OVERALL, AUTH, UNAUTH = RATE_NAMES.values()
SECONDARY, PRIMARY, SPECIAL = "State-funded secondary", "State-funded primary", "Special"


def type_order(column: str = "school_type") -> Column:
    """1-based position of the school type in the report order (0 if unknown)."""
    return F.array_position(F.array(*[F.lit(t) for t in SCHOOL_TYPES]), F.col(column)).cast("int")


def region_type_rates(df: DataFrame, year=None) -> DataFrame:
    """Mean overall, authorised and unauthorised rates per (region, school
    type) at regional level in ``year`` (default: the latest period present)."""
    rows = filter_fact(df, geographic_level=REGIONAL, school_type=SCHOOL_TYPES)
    if year is None:
        # one pass: mean rates per period too, then the latest of those
        # (regions x types x periods) rows
        means = rows.groupBy("region_name", "school_type", "time_period").agg(
            *[F.avg(src).alias(dst) for src, dst in RATE_NAMES.items()]
        )
        means = means.withColumn("latest", F.max("time_period").over(Window.partitionBy()))
        return means.where(F.col("time_period") == F.col("latest")).select("region_name", "school_type", *RATE_NAMES.values())
    rows = filter_year(rows, year)
    return rows.groupBy("region_name", "school_type").agg(
        *[F.avg(src).alias(dst) for src, dst in RATE_NAMES.items()]
    )


def _by_rate_desc() -> list[Column]:
    return [F.desc_nulls_last(OVERALL), F.asc("region_name")]


def top_regions_by_type(rates: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` regions with the highest overall rate for each type (ties by
    region name), ranked from 1."""
    return top_k_per_group(rates, ["school_type"], _by_rate_desc(), k).select(
        "school_type", "rank", "region_name", OVERALL, AUTH, UNAUTH
    )


def highest_by_type(rates: DataFrame) -> DataFrame:
    """The region with the highest overall rate for each type."""
    return top_k_per_group(rates, ["school_type"], _by_rate_desc(), 1).select(
        "school_type", "region_name", OVERALL, AUTH, UNAUTH
    )


def _type_means(rates: DataFrame) -> DataFrame:
    """Unrounded unweighted means over regions of each type's regional means."""
    return rates.groupBy("school_type").agg(
        *[F.avg(c).alias(c) for c in (OVERALL, AUTH, UNAUTH)],
    ).withColumn("type_order", type_order())


def type_averages(rates: DataFrame, include_total: bool = False) -> DataFrame:
    """Mean rates per school type across regions (rounded to 4), highest
    overall first; ``Total`` left out unless asked for."""
    means = _type_means(rates)
    if not include_total:
        means = means.where(F.col("school_type") != F.lit(TOTAL))
    return means.select(
        "school_type", *[F.round(c, 4).alias(c) for c in (OVERALL, AUTH, UNAUTH)], "type_order"
    ).orderBy(F.desc_nulls_last(OVERALL), F.asc("type_order"))


def type_gap(rates: DataFrame) -> DataFrame:
    """One row: the types with the highest and the lowest mean overall rate
    (``Total`` left out; ties resolve in report order) and the gap between
    them (rounded to 4)."""
    means = _type_means(rates).where((F.col("school_type") != F.lit(TOTAL)) & F.col(OVERALL).isNotNull())
    key = F.struct(F.col(OVERALL), -F.col("type_order"))
    return means.agg(
        F.max_by("school_type", key).alias("highest_type"),
        F.min_by("school_type", key).alias("lowest_type"),
        F.round(F.max(OVERALL) - F.min(OVERALL), 4).alias("gap"),
    )


def region_range_by_type(rates: DataFrame) -> DataFrame:
    """Per type (``Total`` left out): the lowest and highest region by overall
    rate (ties by region name), their rates and the difference."""
    rows = rates.where((F.col("school_type") != F.lit(TOTAL)) & F.col(OVERALL).isNotNull())
    rate, region = F.col(OVERALL), F.col("region_name")
    return (
        rows.groupBy("school_type")
        .agg(
            F.min_by(region, F.struct(rate, region)).alias("lowest_region"),
            F.min(rate).alias("lowest_rate"),
            F.min_by(region, F.struct(-rate, region)).alias("highest_region"),
            F.max(rate).alias("highest_rate"),
        )
        .withColumn("diff", F.col("highest_rate") - F.col("lowest_rate"))
        .withColumn("type_order", type_order())
    )


def most_variable_type(rates: DataFrame) -> DataFrame:
    """The type whose regions differ most (ties in report order)."""
    return (
        region_range_by_type(rates)
        .orderBy(F.desc("diff"), F.asc("type_order"))
        .limit(1)
        .select("school_type", F.col("diff").alias("variation"))
    )


def consistent_regions(rates: DataFrame, min_types: int = 2) -> DataFrame:
    """Regions that are highest for at least ``min_types`` school types
    (``Total`` left out), with those types in report order."""
    top = highest_by_type(rates).where(F.col("school_type") != F.lit(TOTAL)).withColumn("type_order", type_order())
    types = F.array_sort(F.collect_list(F.struct("type_order", "school_type")))
    return (
        top.groupBy("region_name")
        .agg(
            F.count(F.lit(1)).alias("n_types"),
            F.array_join(F.transform(types, lambda t: t["school_type"]), ", ").alias("school_types"),
        )
        .where(F.col("n_types") >= min_types)
    )


def phase_unauth_gap(rates: DataFrame) -> DataFrame:
    """One row: mean unauthorised rate of secondary and of primary schools
    (rounded to 4; 0.0 if a type is absent), their gap and whether secondary
    is higher."""
    means = _type_means(rates)
    t = F.col("school_type")

    def mean_of(name: str) -> Column:
        return F.coalesce(F.max(F.when(t == F.lit(name), F.col(UNAUTH))), F.lit(0.0))

    return means.agg(mean_of(SECONDARY).alias("sec"), mean_of(PRIMARY).alias("pri")).select(
        F.round("sec", 4).alias("secondary_unauth"),
        F.round("pri", 4).alias("primary_unauth"),
        F.round(F.col("sec") - F.col("pri"), 4).alias("gap"),
        (F.col("sec") > F.col("pri")).alias("secondary_higher"),
    )


def key_findings(rates: DataFrame) -> DataFrame:
    """One row of findings: the most variable type and its variation, the
    secondary-minus-primary unauthorised gap, the special-school mean and the
    region with the highest ``Total`` rate. Two small aggregates, no join."""
    rate, region = F.col(OVERALL), F.col("region_name")
    per_type = (
        rates.groupBy("school_type")
        .agg(
            F.avg(rate).alias("mean_overall"),
            F.avg(UNAUTH).alias("mean_unauth"),
            (F.max(rate) - F.min(rate)).alias("diff"),
            F.min_by(region, F.struct(-rate, region)).alias("top_region"),
        )
        .withColumn("type_order", type_order())
    )
    t = F.col("school_type")
    non_total = t != F.lit(TOTAL)

    def of_type(name: str, c: str) -> Column:
        return F.max(F.when(t == F.lit(name), F.col(c)))

    sec = F.coalesce(of_type(SECONDARY, "mean_unauth"), F.lit(0.0))
    pri = F.coalesce(of_type(PRIMARY, "mean_unauth"), F.lit(0.0))
    return per_type.agg(
        F.max_by(F.when(non_total, t), F.when(non_total & F.col("diff").isNotNull(), F.struct("diff", -F.col("type_order")))).alias(
            "most_variable_type"
        ),
        F.max(F.when(non_total, F.col("diff"))).alias("variation"),
        F.round(sec - pri, 4).alias("secondary_minus_primary_unauth"),
        F.round(of_type(SPECIAL, "mean_overall"), 4).alias("special_mean_overall"),
        of_type(TOTAL, "top_region").alias("worst_region_total"),
    )
