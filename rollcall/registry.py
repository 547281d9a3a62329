"""Every query the library answers, as ``(spark, sf_dir) -> DataFrame``.

Each one reads the star-schema Parquet tables in ``sf_dir``, derives the fact
table (:func:`rollcall.sources.star.absence`) and applies one report
operator, so its work grows with the input. Parameters are in
:mod:`rollcall.params`; the matching DuckDB SQL is in :mod:`rollcall.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params as P
from .operators import (
    catalog,
    catalog_size,
    check_grain,
    filter_fact,
    filter_members,
    filter_year,
    members_exist,
    pivot_map,
    query,
    row_count,
    search_prefix,
)
from .plans import charts, comparison, links, places, regions
from .schema import FIELD_SETS, GRAIN, LOCAL_AUTHORITY, NATIONAL, REGIONAL, TOTAL
from .session import scratch_path
from .sources import absence, catalogs, derive_fact, increment, load_fact, periods, rank_index, read_checked, read_fact, read_fact_csv, read_star, star_store, write_fact, write_fact_csv

Query = Callable[[SparkSession, str], DataFrame]
#: What makes a local-authority row unique, in the order of a sort's ties.
RANK_KEYS = ["la_name", "time_period", "school_type"]


def _on_fact(op: Callable[[DataFrame], DataFrame], year=None, levels=None, types=None) -> Query:
    """``op`` over the fact table; year, levels and school types that the
    report keeps anyway are handed to the derivation."""
    years = None if year is None else [year] if isinstance(year, (int, str)) else list(year)
    return lambda spark, sf_dir: op(absence(spark, sf_dir, years=years, levels=levels, school_types=types))


def _on_filtered(op: Callable[[DataFrame], DataFrame], filters: dict) -> Query:
    """``op`` over the rows that :func:`filter_fact` keeps of ``filters``; the
    derivation gets its scope from the same filters."""

    def scope(name: str) -> list | None:
        value = filters.get(name)
        return None if value is None else [value] if isinstance(value, (int, str)) else list(value)

    return _on_fact(lambda df: op(filter_fact(df, **filters)), scope("year"), scope("geographic_level"), scope("school_type"))


def _on_unauthorised(op: Callable[..., DataFrame], **arguments) -> Query:
    """``op`` for the page parameters' year and places, over rows of their level."""
    year, by = P.PAGE["year"], P.PAGE["by"]
    return _on_fact(lambda df: op(df, year, by, **arguments), year, [places.level_of(by)], [TOTAL])


def _on_regions(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_fact(op, levels=[REGIONAL], types=[TOTAL])


def _on_rates(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_fact(lambda df: op(links.region_type_rates(df, P.LINK_YEAR)), P.LINK_YEAR, [REGIONAL])


def _fields(set_name: str) -> Query:
    def run(df: DataFrame) -> DataFrame:
        rows = filter_fact(df, year=P.FIELDS_YEAR, geographic_level=LOCAL_AUTHORITY, school_type=TOTAL)
        return query(rows, "la_name", fields=set_name, unique=True)

    return _on_fact(run, P.FIELDS_YEAR, [LOCAL_AUTHORITY], [TOTAL])


def load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact table -> CSV -> (declared-schema read) -> partitioned Parquet -> read."""
    csv_path = write_fact_csv(absence(spark, sf_dir), scratch_path(spark, "fact-csv"))
    parquet_path = write_fact(read_fact_csv(spark, csv_path), scratch_path(spark, "fact-parquet"))
    return read_fact(spark, parquet_path)


def load_fact_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load dispatch: a CSV is read and stored, then the stored table is
    read again without it."""
    csv_path = write_fact_csv(absence(spark, sf_dir), scratch_path(spark, "fact-csv"))
    path = scratch_path(spark, "fact-parquet")
    load_fact(spark, path, csv_path)
    return load_fact(spark, path)


def _later(key: str) -> Column:
    """About a third of the keys, by their hash."""
    return F.coalesce(F.pmod(F.xxhash64(key), F.lit(3)) == 0, F.lit(False))


def fact_by_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table stored, then one year derived and loaded again, twice."""
    table = scratch_path(spark, "fact-periods")
    periods.replace_periods(spark, absence(spark, sf_dir), table)
    for _ in range(2):
        again = absence(spark, sf_dir, years=[P.RELOADED_YEAR])
        periods.replace_periods(spark, again, table, [P.RELOADED_YEAR * 100 + (P.RELOADED_YEAR + 1) % 100])
    return periods.read_periods(spark, table)


def fact_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in which every row of one level comes twice, stored with one
    row per key; the rows kept out are read back and counted per level."""
    table = scratch_path(spark, "fact-keys")
    fact = absence(spark, sf_dir)
    twice = fact.unionByName(fact.where(F.col("geographic_level") == REGIONAL))
    periods.replace_periods(spark, twice, table, grain=GRAIN)
    stored = periods.read_periods(spark, table).groupBy("geographic_level").agg(F.count(F.lit(1)).alias("stored"))
    out = periods.quarantined(spark, table).groupBy("geographic_level").agg(F.sum("copies").alias("kept_out"))
    return stored.join(out, "geographic_level", "left").select("geographic_level", "stored", F.coalesce("kept_out", F.lit(0)).alias("kept_out"))


def _rough_csv(spark: SparkSession, sf_dir: str) -> str:
    """The table as CSV files of two headers (the second: columns reversed and
    one more), with a count that is no number in one level and year."""
    fact = absence(spark, sf_dir)
    spoilt = (F.col("geographic_level") == REGIONAL) & F.col("time_period").between(P.SPOILT_YEAR * 100, P.SPOILT_YEAR * 100 + 99)
    rough = fact.withColumn("enrolments", F.when(spoilt, F.concat(F.col("enrolments").cast("string"), F.lit("?"))).otherwise(F.col("enrolments").cast("string")))
    folder = scratch_path(spark, "rough-csv")
    national = F.col("geographic_level") == NATIONAL
    write_fact_csv(rough.where(national), folder)
    write_fact_csv(rough.where(~national).select(*reversed(rough.columns), F.lit("x").alias("remark")), folder, mode="append")
    return folder


def csv_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of rough CSV files that can be read."""
    return read_checked(spark, _rough_csv(spark, sf_dir))[0].drop("remark")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Their rejects: bad cells and their number, by column and text."""
    rejects = read_checked(spark, _rough_csv(spark, sf_dir))[1]
    return rejects.groupBy("column", "text").agg(F.count_distinct("file", "row").alias("n"))


def _stored_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    path = star_store.store_star(read_star(spark, sf_dir), scratch_path(spark, "star"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return star_store.open_star(spark, path)


def fact_of_stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derivation over lines and orders stored by order key."""
    return derive_fact(_stored_star(spark, sf_dir))


def year_of_stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single-year report over them."""
    fact = derive_fact(_stored_star(spark, sf_dir), [P.UNAUTH_YEAR], [LOCAL_AUTHORITY], [TOTAL])
    return places.unauthorised_by(fact, P.UNAUTH_YEAR, "la")


def fact_of_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star merged in three loads: two thirds of the orders with two
    thirds of their lines; the other orders with all of theirs; the late lines."""
    tables = read_star(spark, sf_dir)
    path = scratch_path(spark, "fact-sums")
    orders, lines = tables["orders"], spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    late_order, late_line = _later("o_orderkey"), F.coalesce(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0, F.lit(False))
    second = _later("l_orderkey")
    increment.create(tables | {"orders": orders.where(~late_order), "lineitem": lines.where(~second & ~late_line)}, path)
    increment.add(spark, path, lines.where(second), orders.where(late_order))
    increment.add(spark, path, lines.where(~second & late_line), orders.limit(0))
    return increment.fact(spark, path, tables)


def ranked_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page deep in the stored sort of all local-authority rows."""
    rows = absence(spark, sf_dir, levels=[LOCAL_AUTHORITY]).select(*RANK_KEYS, "sess_overall", "enrolments")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = rank_index.store_ranked(rows, scratch_path(spark, "fact-ranks"), "sess_overall", RANK_KEYS, ranges)
    return rank_index.ranked_page(spark, path, **P.RANKED)


def la_enrolment_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolments of every local authority by period and school type: the
    pivot over all of them as a map, its cells as text in order of the name."""
    wide = pivot_map(absence(spark, sf_dir, levels=[LOCAL_AUTHORITY]), "time_period", "school_type", pivot="la_name", fields="enrolments")
    texts = F.transform(F.map_entries("cells"), lambda e: F.concat_ws("=", e["key"], e["value"]["enrolments"].cast("string")))
    return wide.select("time_period", "school_type", F.size("cells").cast("bigint").alias("n_las"), F.array_join(texts, ";").alias("enrolments"))


def _catalogued(spark: SparkSession, sf_dir: str) -> str:
    """The whole table stored and catalogued; then one year is replaced by its
    national rows alone, and by all of its rows again."""
    table = scratch_path(spark, "fact-catalogs")
    year = P.RELOADED_YEAR * 100 + (P.RELOADED_YEAR + 1) % 100
    periods.replace_periods(spark, absence(spark, sf_dir), table)
    catalogs.refresh_catalogs(spark, table)
    for levels in ([NATIONAL], None):
        periods.replace_periods(spark, absence(spark, sf_dir, years=[P.RELOADED_YEAR], levels=levels), table, [year])
        catalogs.refresh_catalogs(spark, table)
    return table


def stored_catalog_la(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local authorities and their rows, from the catalogs beside the table."""
    return catalogs.stored_catalog(spark, _catalogued(spark, sf_dir), "la_name")


def stored_catalog_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the catalogs, from those beside the table."""
    return catalogs.stored_sizes(spark, _catalogued(spark, sf_dir))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "build_fact": _on_fact(lambda df: df),
        "check_grain": _on_fact(check_grain),
        "check_grain_repeats": _on_fact(lambda df: check_grain(df, P.GRAIN_WITHOUT_TYPE)),
        "filter_year": _on_fact(lambda df: filter_year(df, P.YEARS_FILTER), P.YEARS_FILTER),
        "filter_members": _on_fact(lambda df: filter_members(df, "geographic_level", P.MEMBER_LEVELS), levels=P.MEMBER_LEVELS),
        "filter_fact": _on_filtered(lambda df: df, P.FILTER_FACT),
        "catalog_la": _on_fact(lambda df: catalog(df, "la_name")),
        "catalog_school_types": _on_fact(lambda df: catalog(df, "school_type")),
        "catalog_regions": _on_fact(lambda df: catalog(df, "region_name")),
        "catalog_size": _on_fact(catalog_size),
        "search_prefix": _on_fact(lambda df: search_prefix(df, P.PREFIXES)),
        "search_prefix_empty": _on_fact(lambda df: search_prefix(df, [])),
        "members_exist": _on_fact(lambda df: members_exist(df, P.EXIST_VALUES)),
    }
    for set_name in FIELD_SETS:
        q[f"fields_{set_name}"] = _fields(set_name)
    ts, cmp, pg = P.TYPE_SEARCH, P.COMPARE, P.PAGE
    q.update(
        {
            "la_enrolment_pivot": _on_fact(lambda df: places.la_enrolment_pivot(df, P.PIVOT_LAS), None, [LOCAL_AUTHORITY], [TOTAL]),
            "school_type_authorised": _on_fact(lambda df: places.school_type_authorised(df, ts["school_type"], ts["year"]), ts["year"], [NATIONAL]),
            "school_type_breakdown": _on_fact(lambda df: places.school_type_breakdown(df, ts["school_type"], ts["year"]), ts["year"], [NATIONAL]),
            "unauthorised_by_region": _on_fact(lambda df: places.unauthorised_by(df, P.UNAUTH_YEAR, "region"), P.UNAUTH_YEAR, [REGIONAL], [TOTAL]),
            "unauthorised_by_la": _on_fact(lambda df: places.unauthorised_by(df, P.UNAUTH_YEAR, "la"), P.UNAUTH_YEAR, [LOCAL_AUTHORITY], [TOTAL]),
            "page_after": _on_unauthorised(places.unauthorised_page_after, after=P.PAGE_AFTER, page_size=pg["page_size"]),
            "page": _on_unauthorised(places.unauthorised_page, page_number=pg["page_number"], page_size=pg["page_size"]),
            "unauthorised_row_count": _on_unauthorised(lambda df, year, by: row_count(places.unauthorised_by(df, year, by))),
            "compare_basic": _on_fact(lambda df: comparison.compare_basic(df, **cmp), cmp["year"], [LOCAL_AUTHORITY], [TOTAL]),
            "compare_authorised": _on_fact(lambda df: comparison.compare_authorised(df, **cmp), cmp["year"], [LOCAL_AUTHORITY], [TOTAL]),
            "compare_unauthorised": _on_fact(lambda df: comparison.compare_unauthorised(df, **cmp), cmp["year"], [LOCAL_AUTHORITY], [TOTAL]),
            "compare_verdicts": _on_fact(lambda df: comparison.compare_verdicts(df, **cmp), cmp["year"], [LOCAL_AUTHORITY], [TOTAL]),
            "main_absence_reason": _on_fact(lambda df: comparison.main_absence_reason(df, P.REASON_YEAR), P.REASON_YEAR, [LOCAL_AUTHORITY], [TOTAL]),
            "region_rates": _on_regions(regions.region_rates),
            "region_overall_pivot": _on_regions(regions.region_overall_pivot),
            "region_overall_rounded": _on_regions(regions.region_overall_rounded),
            "region_average": _on_regions(regions.region_average),
            "region_change": _on_regions(regions.region_change),
            "region_improved": _on_regions(regions.region_improved),
            "region_worsened": _on_regions(regions.region_worsened),
            "region_best": _on_regions(regions.region_best),
            "region_worst": _on_regions(regions.region_worst),
            "region_type_rates_latest": _on_fact(links.region_type_rates, levels=[REGIONAL]),
            "region_type_rates": _on_rates(lambda r: r),
            "top_regions_by_type": _on_rates(lambda r: links.top_regions_by_type(r, P.TOP_K)),
            "highest_by_type": _on_rates(links.highest_by_type),
            "type_averages": _on_rates(links.type_averages),
            "type_gap": _on_rates(links.type_gap),
            "region_range_by_type": _on_rates(links.region_range_by_type),
            "most_variable_type": _on_rates(links.most_variable_type),
            "consistent_regions": _on_rates(lambda r: links.consistent_regions(r, 2)),
            "consistent_regions_min1": _on_rates(lambda r: links.consistent_regions(r, 1)),
            "phase_unauth_gap": _on_rates(links.phase_unauth_gap),
            "key_findings": _on_rates(links.key_findings),
            "chart_region_trend": _on_regions(charts.chart_region_trend),
            "chart_region_type": _on_rates(charts.chart_region_type),
            "chart_type_auth_unauth": _on_rates(charts.chart_type_auth_unauth),
            "chart_heatmap": _on_rates(charts.chart_heatmap),
            "load_roundtrip": load_roundtrip,
            "load_fact": load_fact_stored,
            "csv_accepted": csv_accepted,
            "csv_rejects": csv_rejects,
            "fact_by_periods": fact_by_periods,
            "fact_one_per_key": fact_one_per_key,
            "fact_of_stored_star": fact_of_stored_star,
            "year_of_stored_star": year_of_stored_star,
            "fact_of_increments": fact_of_increments,
            "ranked_page": ranked_page,
            "la_enrolment_map": la_enrolment_map,
            "stored_catalog_la": stored_catalog_la,
            "stored_catalog_size": stored_catalog_size,
        }
    )
    return q
