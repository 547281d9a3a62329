"""Regional performance over time: rates, trend pivot, change between the
first and last period, improved and worsened regions, best and worst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import indicator, period_label
from ..operators import filter_fact, query
from ..schema import REGIONAL, TOTAL
from ..sources.fact_io import store_small

RATES = ["sess_overall_percent", "sess_authorised_percent", "sess_unauthorised_percent"]


def region_rates(df: DataFrame) -> DataFrame:
    """Regional ``Total`` rows: region, period and the three absence rates."""
    rows = filter_fact(df, geographic_level=REGIONAL, school_type=TOTAL)
    return rows.select("region_name", "time_period", *RATES)


def region_overall_pivot(df: DataFrame, periods: Sequence[int] | None = None) -> DataFrame:
    """Overall absence rate, one row per region, one column per period
    (named by the period).

    Without ``periods`` the regional rows (regions x periods) are stored under
    ``spark.checkpoint.dir`` first, so that the search for the periods and the
    pivot read that small table and the derivation runs once.
    """
    rows = region_rates(df)
    if periods is None:
        rows = store_small(rows, "regional-rates")
    return query(
        rows,
        "region_name",
        fields={"sess_overall_percent": "overall_percent"},
        pivot="time_period",
        pivot_values=periods,
        unique=True,
    )


def region_overall_rounded(df: DataFrame, periods: Sequence[int] | None = None) -> DataFrame:
    """The pivot rounded to 2 places, columns labelled by start year."""
    wide = region_overall_pivot(df, periods)
    cols = [c for c in wide.columns if c != "region_name"]
    return wide.select("region_name", *[F.round(F.col(f"`{c}`"), 2).alias(period_label(c)) for c in cols])


def region_average(df: DataFrame) -> DataFrame:
    """Unweighted mean over periods of each region's overall rate, rounded to 4."""
    return (
        region_rates(df)
        .groupBy("region_name")
        .agg(F.round(F.avg("sess_overall_percent"), 4).alias("avg_absence"))
    )


def region_change(df: DataFrame) -> DataFrame:
    """Per region: rate in the first and the last period of the data (rounded
    to 4; null where the region lacks that period), ``change = last - first``,
    the mean rate, and ``indicator`` (``better`` when the rate fell).

    One pass over the input: each region keeps its rates by period (a map
    bounded by the periods), and the period bounds are a window over those
    one-row-per-region results.
    """
    rate, period = F.col("sess_overall_percent"), F.col("time_period")
    per_region = region_rates(df).groupBy("region_name").agg(
        F.collect_list(F.struct(period.alias("p"), rate.alias("v"))).alias("rates"),
        F.min(period).alias("lo"),
        F.max(period).alias("hi"),
        F.avg(rate).alias("mean"),
    )
    all_regions = Window.partitionBy()
    first_p, last_p = F.min("lo").over(all_regions), F.max("hi").over(all_regions)

    def rate_in(p: str) -> Column:
        return F.array_max(F.transform(F.filter("rates", lambda r: r["p"] == F.col(p)), lambda r: r["v"]))

    return (
        per_region.withColumn("first_p", first_p)
        .withColumn("last_p", last_p)
        .select(
            "region_name",
            F.round(rate_in("first_p"), 4).alias("first_period"),
            F.round(rate_in("last_p"), 4).alias("last_period"),
            F.round("mean", 4).alias("avg_absence"),
        )
        .withColumn("change", F.round(F.col("last_period") - F.col("first_period"), 4))
        .select(
            "region_name",
            "first_period",
            "last_period",
            "change",
            "avg_absence",
            indicator(F.col("change"), F.lit(0.0), F.lit("rate")).alias("indicator"),
        )
    )


def region_improved(df: DataFrame) -> DataFrame:
    """Regions whose rate fell, with the size of the fall, largest first."""
    return (
        region_change(df)
        .where(F.col("change") < 0)
        .withColumn("decrease", F.abs(F.col("change")))
        .orderBy(F.asc("change"), F.asc("region_name"))
    )


def region_worsened(df: DataFrame) -> DataFrame:
    """Regions whose rate rose, largest rise first."""
    return (
        region_change(df)
        .where(F.col("change") > 0)
        .withColumn("increase", F.col("change"))
        .orderBy(F.desc("change"), F.asc("region_name"))
    )


def region_best(df: DataFrame) -> DataFrame:
    """The region with the lowest mean rate (ties by name)."""
    return region_average(df).orderBy(F.asc_nulls_last("avg_absence"), F.asc("region_name")).limit(1)


def region_worst(df: DataFrame) -> DataFrame:
    """The region with the highest mean rate (ties by name)."""
    return region_average(df).orderBy(F.desc_nulls_last("avg_absence"), F.asc("region_name")).limit(1)
