"""Stored tables that change in part: periods, bucketed stars, merged sums."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollcall.schema import GRAIN
from rollcall.sources import absence, commits, derive_fact, increment, periods, read_star, star_store
from rollcall.sources.star import STAR_SCHEMAS

from .conftest import SF_SMALL


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def fact(spark):
    return absence(spark, SF_SMALL).cache()


def table_of(make_fact, values):
    return make_fact([{"time_period": p, "geographic_level": lv, "school_type": "Total", "enrolments": e} for p, lv, e in values])


def keys(df):
    return sorted((r.time_period, r.geographic_level, r.enrolments) for r in df.collect())


def test_reload_of_a_period_is_idempotent_and_leaves_the_rest(spark, make_fact, tmp_path):
    table = f"{tmp_path}/t"
    first = [(201617, "National", 1), (201617, "Regional", 2), (201718, "National", 3)]
    assert periods.replace_periods(spark, table_of(make_fact, first), table) == 1
    files = set(periods.read_periods(spark, table, years=[2017]).inputFiles())
    for version in (2, 3):
        assert periods.replace_periods(spark, table_of(make_fact, [(201617, "National", 10)]), table, [201617]) == version
        assert keys(periods.read_periods(spark, table)) == [(201617, "National", 10), (201718, "National", 3)]  # the level without rows is gone
    assert set(periods.read_periods(spark, table, years=[2017]).inputFiles()) == files  # not rewritten
    assert keys(periods.read_periods(spark, table, version=1)) == sorted(first)
    assert periods.drop_unused(spark, table) == [2]
    assert keys(periods.read_periods(spark, table)) == [(201617, "National", 10), (201718, "National", 3)]
    with pytest.raises(ValueError, match="version 1"):
        periods.read_periods(spark, table, version=1)
    periods.replace_periods(spark, table_of(make_fact, []), table, [201617, 201718])
    assert periods.read_periods(spark, table).collect() == []


def test_a_lost_load_changes_nothing(spark, make_fact, tmp_path):
    table = f"{tmp_path}/t"
    good = table_of(make_fact, [(201617, "National", 1), (201718, "National", 2)])
    periods.replace_periods(spark, good, table)
    broken = good.withColumn("enrolments", F.when(F.col("time_period") == 201718, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.lit(9)))
    with pytest.raises(Exception, match="lost"):
        periods.replace_periods(spark, broken, table)
    assert keys(periods.read_periods(spark, table)) == [(201617, "National", 1), (201718, "National", 2)]
    with pytest.raises(Exception, match="period not in this load"):
        periods.replace_periods(spark, good, table, [201617])
    # lost between the files and the marker, and while the marker was written
    good.write.partitionBy(*periods.PARTITIONS).parquet(f"{table}/loads/load=70")
    spark.createDataFrame([("National", 201617, 70)], periods.COMMIT_SCHEMA).write.parquet(f"{table}/commits/v9")
    commits.delete(spark, f"{table}/commits/v9/_SUCCESS")
    assert commits.versions(spark, table) == [1]
    assert keys(periods.read_periods(spark, table)) == [(201617, "National", 1), (201718, "National", 2)]
    assert periods.replace_periods(spark, table_of(make_fact, [(201617, "National", 5)]), table) == 10  # no lost number is used again
    assert keys(periods.read_periods(spark, table)) == [(201617, "National", 5), (201718, "National", 2)]


def test_repeated_keys_are_kept_out(spark, make_fact, tmp_path):
    table = f"{tmp_path}/t"
    values = [(201617, "National", 1), (201617, "Regional", 4)] + [(201617, "Regional", 3)] * 50 + [(None, "Regional", 7)] * 2
    periods.replace_periods(spark, table_of(make_fact, values), table, grain=GRAIN)
    stored = [(r.time_period, r.geographic_level, r.enrolments) for r in periods.read_periods(spark, table).collect()]
    assert sorted(stored, key=repr) == sorted([(201617, "National", 1), (201617, "Regional", 3), (None, "Regional", 7)], key=repr)
    out = [(r.time_period, r.enrolments, r.copies) for r in periods.quarantined(spark, table).collect()]
    assert sorted(out, key=repr) == sorted([(201617, 3, 49), (201617, 4, 1), (None, 7, 1)], key=repr)
    assert periods.quarantined(spark, f"{tmp_path}/none").collect() == []


def test_scans_of_years_and_levels_read_their_folders_only(spark, fact, tmp_path):
    table = f"{tmp_path}/t"
    periods.replace_periods(spark, fact, table)
    files = periods.read_periods(spark, table, years=[2018], levels=["Regional"]).inputFiles()
    assert files and all("time_period=201819" in f and "geographic_level=Regional" in f for f in files)
    assert rows_of(periods.read_periods(spark, table)) == rows_of(fact)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('star')}/star"
    return star_store.store_star(read_star(spark, SF_SMALL), path, 6)


@pytest.mark.parametrize("years", [None, [2018]])
def test_stored_lines_and_orders_do_not_move(spark, stored, years):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = derive_fact(star_store.open_star(spark, stored), years)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert rows_of(df) == rows_of(absence(spark, SF_SMALL, years=years))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    # from the scan of either table up to the join of orders there is no Exchange
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line and "[orderkey" in line]
    assert len(joins) == 1
    depth = lines[joins[0]].index("SortMergeJoin")
    below = []
    for line in lines[joins[0] + 1 :]:
        if len(line) - len(line.lstrip(" :+-*()0123456789")) <= depth - 3:
            break
        below.append(line)
    scans = [line for line in below if "FileScan" in line]
    assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
    assert not any("Exchange" in line for line in below)
    if years:
        assert any("GreaterThanOrEqual(o_orderdate" in line for line in scans)


def test_a_hot_order_is_a_few_stored_rows(spark, stored):
    lines = star_store.open_star(spark, stored)["lines"]
    assert lines.groupBy("orderkey").count().agg(F.max("count")).first()[0] <= 6
    raw = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert lines.agg(F.sum("n_lines")).first()[0] == raw


def split(key, n, *more):
    return F.pmod(F.xxhash64(key, *more), F.lit(n))


def test_merged_deltas_equal_the_whole_derivation(spark, fact, tmp_path):
    tables = read_star(spark, SF_SMALL)
    orders, lines = tables["orders"], spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    # null quantities and flags, so that sums of nothing meet sums
    lines = lines.withColumn("l_quantity", F.when(split("l_orderkey", 11, "l_linenumber") > 0, F.col("l_quantity")))
    whole = derive_fact(tables | {"lineitem": lines})
    path = f"{tmp_path}/sums"
    order_part, line_part = split("o_orderkey", 4), split("l_linenumber", 4, "l_orderkey")
    increment.create(tables | {"orders": orders.where(order_part == 0), "lineitem": lines.where(line_part == 0)}, path)
    for n in (1, 2, 3):  # late lines of known orders, new orders, and lines that wait for their order
        assert increment.add(spark, path, lines.where(line_part == n), orders.where(order_part == n)) == n + 1
    assert rows_of(increment.fact(spark, path, tables)) == rows_of(whole)
    part = derive_fact(tables | {"orders": orders.where(order_part <= 1), "lineitem": lines.where(line_part <= 1)})
    assert rows_of(increment.fact(spark, path, tables, version=2)) == rows_of(part)
    increment.compact(spark, path)
    assert rows_of(increment.fact(spark, path, tables)) == rows_of(whole)
    assert increment.open_sums(spark, path).lines.groupBy("orderkey", "flag", "status").count().where("count > 1").count() == 0


def test_a_delta_without_rows_and_a_known_order(spark, fact, tmp_path):
    tables = read_star(spark, SF_SMALL)
    path = f"{tmp_path}/sums"
    increment.create(tables, path)
    increment.add(spark, path, tables["lineitem"].limit(0), tables["orders"].limit(0))
    assert rows_of(increment.fact(spark, path, tables)) == rows_of(fact)
    with pytest.raises(Exception, match="order is in the table already"):
        increment.add(spark, path, tables["lineitem"].limit(0), tables["orders"].limit(3))
    assert rows_of(increment.fact(spark, path, tables)) == rows_of(fact)  # the lost load is not seen
    with pytest.raises(ValueError, match="holds a state already"):
        increment.create(tables, path)


def test_touched_orders_are_summed_in_a_set_number_of_tasks(spark, tmp_path, monkeypatch):
    """Adaptive execution joins partitions by compressed bytes, of which sums take many times as much in memory."""
    lines = spark.createDataFrame([(o, 5.0, "A", "F") for o in range(60)], STAR_SCHEMAS["lineitem"])
    orders = spark.sql("SELECT id AS o_orderkey, id % 4 AS o_custkey, TIMESTAMP_NTZ'1995-03-01' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(60)")
    path = str(tmp_path / "state")
    increment.create({"lineitem": lines.where("l_orderkey < 40"), "orders": orders.where("o_orderkey < 40")}, path)
    monkeypatch.setattr(increment, "TASK_BYTES", 100)
    parts = increment._parts(spark, path, [1])
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions"))  # by the bytes that are stored
    change = increment.changes(increment.open_sums(spark, path), lines, orders.where("o_orderkey >= 40"), parts)
    assert change.schools.groupBy().sum("pupils", "sess_possible").first()[:] == (20, 300)
    plan = change.schools._jdf.queryExecution().toString()
    assert plan.count(f"hashpartitioning(orderkey#") and plan.count(f", {parts}), REPARTITION_BY_NUM") >= 2



def test_csv_files_of_different_headers_with_rejects(spark, make_fact, tmp_path):
    from rollcall.schema import FACT_COLUMNS
    from rollcall.sources import read_checked

    def line(columns, **cells):
        return ",".join(str(cells.get(c, "")) for c in columns)

    folder = tmp_path / "csv"
    folder.mkdir()
    swapped = ["remark", *reversed(FACT_COLUMNS)]
    good = [line(FACT_COLUMNS, time_period=201617, la_name="A", enrolments=i) for i in range(4000)]
    good[1700] = line(FACT_COLUMNS, time_period="2016/17", la_name="A", enrolments="x")  # x is a marker, the period is not
    good[3999] = line(FACT_COLUMNS, time_period=201617, enrolments="4o", sess_possible="many")
    (folder / "a.csv").write_text("\n".join([",".join(FACT_COLUMNS), *good]) + "\n")
    (folder / "b.csv").write_text("\n".join([",".join(swapped), line(swapped, time_period=201718, la_name="B", enrolments="1", remark="seen")]) + "\n")
    (folder / "c.csv").write_text("\n".join(["﻿" + ",".join(FACT_COLUMNS), line(FACT_COLUMNS, time_period=201819, la_name="C"), "1,2"]) + "\n")
    (folder / "empty.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # several splits a file
    try:
        accepted, rejects = read_checked(spark, str(folder))
        got = sorted((r.file.rsplit("/", 1)[1], r.row, r.column, r.text) for r in rejects.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("a.csv", 1701, "time_period", "2016/17"), ("a.csv", 4000, "enrolments", "4o"), ("a.csv", 4000, "sess_possible", "many"),
                   ("c.csv", 2, None, "1,2")]
    rows = accepted.select("time_period", "la_name", "enrolments", "remark").collect()
    assert len(rows) == 3998 + 1 + 1
    assert sorted((tuple(r) for r in rows if r.la_name != "A"), key=repr) == [(201718, "B", 1, "seen"), (201819, "C", None, None)]
    (folder / "d.csv").write_text("time_period,la_name\n1,2\n")
    with pytest.raises(ValueError, match="missing"):
        read_checked(spark, str(folder))
