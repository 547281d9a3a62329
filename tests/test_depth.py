"""Pages of a stored sort, pivots as maps, catalogs beside a stored table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import map_cells, map_columns, pivot_map, query
from rollcall.sources import catalogs, commits, periods, rank_index

RANK_SCHEMA = "name string, turn int, amount long, rank string"


@pytest.fixture(scope="module")
def amounts(spark):
    """A third of the rows share one amount, some have none."""
    rng = random.Random(5)
    rows = [(f"n{rng.randrange(40):02d}" if i % 11 else None, i, 7 if i % 3 == 0 else rng.randrange(30) if i % 13 else None, "x") for i in range(500)]
    rng.shuffle(rows)
    return rows


def test_every_page_of_a_stored_sort(spark, amounts, tmp_path):
    path = rank_index.store_ranked(spark.createDataFrame(amounts, RANK_SCHEMA), f"{tmp_path}/r", "amount", ["name", "turn"], 6)
    want = sorted(amounts, key=lambda r: (r[2] is None, -(r[2] or 0), r[0] is None, r[0] or "", r[1]))
    assert rank_index.ranked_rows(spark, path) == 500
    got = []
    for number in range(1, 10):
        page = rank_index.ranked_page(spark, path, number, 60).orderBy("rank").collect()
        assert [r.rank for r in page] == [i + 1 for i in range((number - 1) * 60, min(number * 60, 500))]
        got += [(r.name, r.turn, r.amount) for r in page]
    assert got == [r[:3] for r in want]
    beyond = rank_index.ranked_page(spark, path, 11, 60)
    assert beyond.collect() == [] and dict(beyond.dtypes)["rank"] == "bigint"
    with pytest.raises(ValueError, match="positive"):
        rank_index.ranked_page(spark, path, 0, 60)


def test_a_deep_page_reads_its_range_only(spark, tmp_path):
    rows = spark.range(0, 100_000, 1, 4).select(F.col("id").alias("turn"), (F.col("id") * 7919 % 100_003).alias("amount"))
    path = rank_index.store_ranked(rows, f"{tmp_path}/r", "amount", ["turn"], 20)
    page = rank_index.ranked_page(spark, path, 7_777, 10)
    folders = {f.split("/")[-2] for f in page.inputFiles()}
    assert 1 <= len(folders) <= 2 < len(commits.names_in(spark, f"{path}/rows"))
    want = sorted(((i * 7919 % 100_003, i) for i in range(100_000)), key=lambda r: (-r[0], r[1]))[77_760:77_770]
    assert [(r.amount, r.turn) for r in page.orderBy("rank").collect()] == want


def test_empty_and_lost_sorts(spark, tmp_path):
    empty = spark.createDataFrame([], RANK_SCHEMA)
    path = rank_index.store_ranked(empty, f"{tmp_path}/e", "amount", ["name"], 3)
    assert rank_index.ranked_rows(spark, path) == 0 and rank_index.ranked_page(spark, path).collect() == []
    commits.delete(spark, f"{path}/schema/_SUCCESS")
    with pytest.raises(ValueError, match="no complete index"):
        rank_index.ranked_page(spark, path)


def test_pivot_of_20000_values_runs_no_job(spark):
    n = 20_000
    rows = spark.range(2 * n).select((F.col("id") % 2).alias("year"), F.concat(F.lit("v"), F.col("id") % n).alias("place"), F.col("id").alias("sessions"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivot-map", "planning only")
    try:
        wide = pivot_map(rows, "year", pivot="place", fields={"sessions": "total"})
        assert list(tracker.getJobIdsForGroup("pivot-map")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    sizes = {r.year: r.n for r in wide.select("year", F.size("cells").alias("n")).collect()}
    assert sizes == {0: n // 2, 1: n // 2}
    cells = map_cells(wide, "place")
    assert cells.count() == n
    assert cells.where((F.col("year") == 0) & (F.col("place") == "v4")).first().total == n + 4
    with pytest.raises(Exception, match="(?i)pivot"):
        query(rows, "year", fields={"sessions": "total"}, pivot="place").collect()


def test_pivot_map_equals_the_pivot(spark):
    rows = spark.createDataFrame(
        [(1, "b", 5, 1.0), (1, "a", 2, None), (1, "b", 5, 1.0), (2, "a", None, 3.0), (2, None, 9, 4.0), (None, "c", 8, 2.0), (3, None, 1, None)],
        "g int, p string, x int, y double",
    )
    fields = {"x": "X", "y": "Y"}
    wide = pivot_map(rows, "g", pivot="p", fields=fields)
    by_column = query(rows.where("p is not null"), "g", fields=fields, pivot="p", pivot_values=["a", "b", "c", "none"], unique=True)
    known = map_columns(wide, ["a", "b", "c", "none"], ["X", "Y"])
    assert known.columns == by_column.columns
    assert sorted(map(repr, known.where("g is null or g < 3").collect())) == sorted(map(repr, by_column.collect()))
    nulls = {r.g: r.cell_of_null for r in wide.collect()}
    assert tuple(nulls[2]) == (9, 4.0) and tuple(nulls[3]) == (1, None) and nulls[1] is None
    want = [(1, "a", 2, None), (1, "b", 5, 1.0), (2, "a", None, 3.0), (2, None, 9, 4.0), (3, None, 1, None), (None, "c", 8, 2.0)]
    assert sorted(map(repr, map(tuple, map_cells(wide, "p").collect()))) == sorted(map(repr, want))
    assert map_columns(wide, ["a"], ["X"]).columns == ["g", "a"]
    assert pivot_map(rows.limit(0), "g", pivot="p", fields=fields).collect() == []
    assert list(pivot_map(rows, pivot="p", fields={"x": "X"}).first().cells) == ["a", "b", "c"]


def places_of(make_fact, period, names):
    return make_fact([{"time_period": period, "geographic_level": "Local authority", "region_name": n[0], "la_name": n, "school_type": "Total"} for n in names])


def members(spark, table, version=None):
    return {r.la_name: r.rows for r in catalogs.stored_catalog(spark, table, "la_name", version).collect()}


def test_catalogs_follow_loads_and_replacements(spark, make_fact, tmp_path):
    table = f"{tmp_path}/t"
    first = places_of(make_fact, 201617, ["a1", "a2", "b1", "b1"]).unionByName(places_of(make_fact, 201718, ["a1", "c1"]))
    periods.replace_periods(spark, first, table)
    with pytest.raises(ValueError, match="refresh_catalogs"):
        catalogs.stored_sizes(spark, table)
    assert catalogs.refresh_catalogs(spark, table) == [1] and catalogs.refresh_catalogs(spark, table) == []
    assert members(spark, table) == {"a1": 2, "a2": 1, "b1": 2, "c1": 1}
    # a period replaced by other members, and one that is emptied
    periods.replace_periods(spark, places_of(make_fact, 201617, ["a1", "d1"]), table)
    # a run lost between members and sketches is made up for
    spark.range(3).write.parquet(f"{table}/catalogs/members/load=2")
    assert catalogs.refresh_catalogs(spark, table) == [2]
    assert members(spark, table) == {"a1": 2, "c1": 1, "d1": 1}
    assert members(spark, table, version=1) == {"a1": 2, "a2": 1, "b1": 2, "c1": 1}
    sizes = catalogs.stored_sizes(spark, table).first()
    assert (sizes.n_la_name, sizes.n_school_type, sizes.n_region_name) == (3, 1, 3)
    assert tuple(catalogs.stored_sizes_approx(spark, table).first()) == (3, 1, 3)
    periods.replace_periods(spark, places_of(make_fact, 1, []), table, [201617, 201718])
    assert members(spark, table) == {} and catalogs.refresh_catalogs(spark, table) == []
    assert tuple(catalogs.stored_sizes(spark, table).first()) == tuple(catalogs.stored_sizes_approx(spark, table).first()) == (0, 0, 0)


def test_sketches_of_many_members(spark, make_fact, tmp_path):
    table = f"{tmp_path}/t"
    one = make_fact([{"geographic_level": "Local authority", "school_type": "Total"}]).drop("time_period", "la_name")
    ids = spark.range(40_000).select(F.col("id").cast("string").alias("la_name"), (F.col("id") % 4).cast("int").alias("time_period"))
    periods.replace_periods(spark, one.crossJoin(ids), table)
    catalogs.refresh_catalogs(spark, table)
    # all members again in another period: the union counts them once
    periods.replace_periods(spark, one.crossJoin(ids.withColumn("time_period", F.lit(9))), table)
    catalogs.refresh_catalogs(spark, table)
    assert catalogs.stored_sizes(spark, table, ["la_name"]).first()[0] == 40_000
    assert abs(catalogs.stored_sizes_approx(spark, table, ["la_name"]).first()[0] - 40_000) < 0.06 * 40_000
