"""Operators on hand-written rows: nulls, ties, zero denominators, duplicates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollcall.functions import main_reason, pct, period_in_years, year_bounds
from rollcall.operators import (
    catalog,
    catalog_size,
    check_grain,
    compare_metrics,
    filter_fact,
    filter_members,
    filter_year,
    members_exist,
    page,
    query,
    search_prefix,
    top_k_per_group,
)
from rollcall.plans import charts, comparison, links, places, regions

LA, REG, NAT = "Local authority", "Regional", "National"


def test_pct_zero_and_null(spark):
    df = spark.createDataFrame([(5, 0), (None, 10), (5, None), (5, 20)], "v long, t long")
    got = [r[0] for r in df.select(pct("v", "t")).collect()]
    assert got == [0.0, 0.0, 0.0, 25.0]


def test_year_filter_is_a_range(spark, make_fact):
    df = make_fact([{"time_period": 201718}, {"time_period": 201819}, {"time_period": 201899}])
    assert sorted(r[0] for r in filter_year(df, 2018).select("time_period").collect()) == [201819, 201899]
    assert filter_year(df, []).count() == 0
    assert sorted(r[0] for r in filter_year(df, ["2017", 2018]).select("time_period").collect()) == [201718, 201819, 201899]
    with pytest.raises(ValueError):
        year_bounds("18")
    assert "BETWEEN" not in str(period_in_years(2018))  # built as >= / <= on the int column


def test_filter_fact_conjunction(make_fact):
    df = make_fact(
        [
            {"time_period": 201819, "geographic_level": LA, "school_type": "Total", "la_name": "A"},
            {"time_period": 201819, "geographic_level": LA, "school_type": "Special", "la_name": "A"},
            {"time_period": 201718, "geographic_level": LA, "school_type": "Total", "la_name": "A"},
            {"time_period": 201819, "geographic_level": LA, "school_type": "Total", "la_name": "B"},
        ]
    )
    out = filter_fact(df, year=2018, geographic_level=LA, school_type="Total", la_name=["A"])
    assert out.count() == 1
    assert filter_fact(df).count() == 4
    assert filter_members(df, "la_name", []).count() == 0
    with pytest.raises(ValueError):
        filter_fact(df, school_type=" ")


def test_comparison_kinds(spark, make_fact):
    df = make_fact(
        [
            {"la_name": "P", "num_schools": 3, "sess_overall_percent": 4.5, "sess_authorised_percent": 5.0,
             "sess_unauthorised_percent": 6.0},
            {"la_name": "Q", "num_schools": 2, "sess_overall_percent": 5.0, "sess_authorised_percent": 5.0,
             "sess_unauthorised_percent": 5.0},
        ]
    )
    metrics = [
        ("overall", F.col("sess_overall_percent"), "rate"),
        ("auth", F.col("sess_authorised_percent"), "rate"),
        ("unauth", F.col("sess_unauthorised_percent"), "rate"),
        ("schools", F.col("num_schools"), "count"),
        ("missing", F.when(F.col("la_name") == "Q", F.lit(1.0)), "rate"),
        ("higher_is_better", F.col("sess_unauthorised_percent"), "reverse"),
    ]
    rows = {r.metric: r for r in compare_metrics(df, "la_name", "P", "Q", metrics).collect()}
    assert rows["overall"].indicator == "better"
    assert rows["auth"].indicator == "same"
    assert rows["unauth"].indicator == "worse"
    assert rows["schools"].indicator is None and rows["schools"].diff == 1.0
    assert rows["higher_is_better"].indicator == "better"
    assert rows["missing"].diff is None and rows["missing"].indicator is None


def test_verdict_tie_goes_to_second(make_fact):
    df = make_fact(
        [
            {"time_period": 201516, "geographic_level": LA, "school_type": "Total", "la_name": "P",
             "sess_overall_percent": 5.0, "enrolments_pa_10_exact_percent": 1.0},
            {"time_period": 201516, "geographic_level": LA, "school_type": "Total", "la_name": "Q",
             "sess_overall_percent": 5.0, "enrolments_pa_10_exact_percent": 2.0},
        ]
    )
    r = comparison.compare_verdicts(df, "P", "Q", 2015).collect()[0]
    assert r.better_attendance == "Q"
    assert r.lower_persistent_absence == "P"


def test_comparison_args_checked(make_fact):
    df = make_fact([{}])
    with pytest.raises(ValueError):
        comparison.compare_basic(df, "P", "P", 2015)
    with pytest.raises(ValueError):
        comparison.compare_basic(df, "P", "Q", 2030, last_year=2018)
    with pytest.raises(ValueError):
        comparison.compare_basic(df, "P", "Q", "20x5")


def test_main_reason_tie_and_nulls(spark, make_fact):
    df = make_fact(
        [
            {"la_name": "tie", "sess_auth_illness": 7, "sess_unauth_late": 7},
            {"la_name": "null", "sess_auth_study": None, "sess_unauth_noyet": 3},
        ]
    )
    got = dict(df.select("la_name", main_reason().alias("r")).collect())
    assert got == {"tie": "Illness", "null": "No Reason Yet"}
    allnull = spark.createDataFrame([(None,)], "sess_auth_illness long")
    assert allnull.select(main_reason([("Illness", "sess_auth_illness")])).collect()[0][0] is None


def test_check_grain(make_fact):
    key = {"time_period": 201819, "geographic_level": NAT, "school_type": "Total"}
    df = make_fact([key, key, {**key, "school_type": "Special"}])
    dup = check_grain(df).collect()
    assert len(dup) == 1 and dup[0].n == 2


def test_search_prefix(make_fact):
    df = make_fact([{"la_name": n} for n in ["Stockport", "Southwark", "stoke", "Barnet", "100%", None]])
    rows = search_prefix(df, ["s", "ST", "%"]).collect()
    got = {(r.prefix, r.la_name) for r in rows}
    assert got == {("s", "Southwark"), ("s", "Stockport"), ("s", "stoke"), ("st", "Stockport"), ("st", "stoke")}
    first = search_prefix(df, [], default_rows=2).collect()
    assert [r.la_name for r in first] == ["100%", "Barnet"]


def test_catalogs_and_membership(make_fact):
    df = make_fact([{"la_name": "B"}, {"la_name": "A"}, {"la_name": "A"}, {"la_name": None, "region_name": "R"}])
    assert [r[0] for r in catalog(df, "la_name").collect()] == ["A", "B"]
    size = catalog_size(df).collect()[0]
    assert (size.n_la_name, size.n_region_name) == (2, 1)
    assert dict(members_exist(df, ["A", "Z"]).collect()) == {"A": True, "Z": False}


def test_query_pick_is_deterministic(make_fact):
    df = make_fact(
        [
            {"time_period": 201819, "geographic_level": LA, "la_name": "A", "school_type": "Total", "enrolments": 5},
            {"time_period": 201819, "geographic_level": LA, "la_name": "A", "school_type": "Special", "enrolments": 9},
        ]
    )
    # Duplicate grain for la_name: the row with the smallest remaining grain key wins.
    r = query(df, "la_name", fields="enrolments").collect()[0]
    assert r.enrolments == 9  # "Special" < "Total"
    with pytest.raises(ValueError):
        query(df, "la_name", fields="nope")


def test_pivot_by_la(make_fact):
    rows = [
        {"time_period": p, "geographic_level": LA, "school_type": "Total", "la_name": la, "enrolments": e}
        for p, la, e in [(201718, "A", 1), (201819, "A", 2), (201819, "B", 3)]
    ]
    out = places.la_enrolment_pivot(make_fact(rows), ["A", "B", "A"])
    assert out.columns == ["time_period", "A", "B"]
    assert [tuple(r) for r in out.collect()] == [(201718, 1, None), (201819, 2, 3)]


def test_top_k_tie_by_name(spark):
    df = spark.createDataFrame(
        [("t", "b", 5.0), ("t", "a", 5.0), ("t", "c", 4.0), ("u", "z", 1.0)], "school_type string, region_name string, v double"
    )
    out = top_k_per_group(df, ["school_type"], [F.desc("v"), F.asc("region_name")], 2).collect()
    assert [(r.school_type, r.region_name, r["rank"]) for r in sorted(out)] == [("t", "a", 1), ("t", "b", 2), ("u", "z", 1)]


def test_page_sizes(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    assert [r.k for r in page(df, ["k"], 3, 10).collect()] == list(range(20, 25))
    assert page(df, ["k"], 4, 10).count() == 0
    with pytest.raises(ValueError):
        page(df, ["k"], 0, 10)


def _rates(spark, rows):
    return spark.createDataFrame(
        rows,
        "region_name string, school_type string, overall_absence_rate double, "
        "authorised_absence_rate double, unauthorised_absence_rate double",
    )


def test_missing_cell_is_zero(spark):
    rates = _rates(
        spark,
        [
            ("R1", "Special", 9.0, 6.0, 3.0),
            ("R1", "State-funded primary", 4.0, 3.0, 1.0),
            ("R1", "State-funded secondary", 5.0, 3.0, 2.0),
            ("R2", "Special", 8.0, 6.0, 2.0),
            ("R2", "Total", 5.0, 4.0, 1.0),
        ],
    )
    bars = {r.region_name: r for r in charts.chart_region_type(rates).collect()}
    assert bars["R2"]["State-funded primary"] == 0.0
    heat = {(r.region_name, r.school_type): r.absence_rate for r in charts.chart_heatmap(rates).collect()}
    assert len(heat) == 6 and heat[("R2", "State-funded secondary")] == 0.0


def test_links_ties_and_findings(spark):
    rates = _rates(
        spark,
        [
            ("A", "Special", 9.0, 6.0, 3.0),
            ("B", "Special", 9.0, 6.0, 3.0),
            ("A", "State-funded secondary", 6.0, 3.0, 3.0),
            ("B", "State-funded secondary", 5.0, 3.0, 2.0),
            ("A", "State-funded primary", 4.0, 3.0, 1.0),
            ("B", "State-funded primary", 4.5, 3.0, 1.5),
            ("A", "Total", 6.0, 4.0, 2.0),
            ("B", "Total", 6.5, 4.0, 2.5),
        ],
    )
    hi = {r.school_type: r.region_name for r in links.highest_by_type(rates).collect()}
    assert hi == {"Special": "A", "State-funded secondary": "A", "State-funded primary": "B", "Total": "B"}
    cons = links.consistent_regions(rates).collect()
    assert [(r.region_name, r.n_types, r.school_types) for r in cons] == [("A", 2, "Special, State-funded secondary")]
    gap = links.type_gap(rates).collect()[0]
    assert (gap.highest_type, gap.lowest_type, gap.gap) == ("Special", "State-funded primary", 4.75)
    rng = {r.school_type: r for r in links.region_range_by_type(rates).collect()}
    assert (rng["Special"].lowest_region, rng["Special"].highest_region, rng["Special"].diff) == ("A", "A", 0.0)
    mv = links.most_variable_type(rates).collect()[0]
    assert (mv.school_type, mv.variation) == ("State-funded secondary", 1.0)
    kf = links.key_findings(rates).collect()[0]
    assert kf.most_variable_type == "State-funded secondary" and kf.worst_region_total == "B"
    assert kf.special_mean_overall == 9.0 and kf.secondary_minus_primary_unauth == 1.25
    ph = links.phase_unauth_gap(rates).collect()[0]
    assert ph.secondary_higher and ph.gap == 1.25


def test_region_change_uses_global_bounds(make_fact):
    def row(region, period, rate):
        return {"time_period": period, "geographic_level": REG, "school_type": "Total",
                "region_name": region, "sess_overall_percent": rate}

    df = make_fact([row("A", 201213, 5.0), row("A", 201819, 4.0), row("B", 201314, 6.0), row("B", 201819, 7.0)])
    got = {r.region_name: r for r in regions.region_change(df).collect()}
    assert got["A"].change == -1.0 and got["A"].first_period == 5.0
    assert got["B"].first_period is None and got["B"].change is None
    assert [r.region_name for r in regions.region_improved(df).collect()] == ["A"]
    assert regions.region_worsened(df).count() == 0
    assert regions.region_best(df).collect()[0].region_name == "A"
    wide = regions.region_overall_rounded(df)
    assert wide.columns == ["region_name", "2012", "2013", "2018"]


def test_csv_markers_become_null(spark, tmp_path, make_fact):
    from rollcall.schema import FACT_COLUMNS
    from rollcall.sources import read_fact_csv

    header = ",".join(FACT_COLUMNS + ["extra_note"])
    values = {c: "1" for c in FACT_COLUMNS}
    values.update({"time_period": "201819", "geographic_level": "National", "school_type": "Total",
                   "region_name": "", "la_name": ""})
    row1 = dict(values, num_schools="x", sess_overall_percent="1.5")
    row2 = dict(values, num_schools="", enrolments=" 12 ")
    path = tmp_path / "fact.csv"
    path.write_text(
        header + "\n"
        + "\n".join(",".join([r[c] for c in FACT_COLUMNS] + ["n"]) for r in (row1, row2)) + "\n"
    )
    df = read_fact_csv(spark, str(path))
    assert dict(df.dtypes)["num_schools"] == "bigint"
    rows = df.orderBy("enrolments").collect()
    assert rows[0].num_schools is None and rows[1].num_schools is None
    assert rows[0].sess_overall_percent == 1.5 and rows[1].enrolments == 12
    assert rows[0].region_name is None and rows[0].extra_note == "n"


def test_has_any(make_fact):
    from rollcall.operators import has_any

    df = make_fact([{"la_name": "A"}, {"la_name": "B"}])
    assert has_any(df, "la_name", ["Z", "B"])
    assert not has_any(df, "la_name", ["Z"])
    assert not has_any(df, "la_name", [])


def test_load_fact_modes(spark, tmp_path, make_fact):
    from rollcall.sources import load_fact, write_fact_csv

    first = make_fact([{"time_period": 201819, "geographic_level": NAT, "school_type": "Total", "enrolments": 1}])
    second = make_fact([{"time_period": 201819, "geographic_level": NAT, "school_type": "Total", "enrolments": 2}])
    csv1 = write_fact_csv(first, str(tmp_path / "one.csv"))
    csv2 = write_fact_csv(second, str(tmp_path / "two.csv"))
    target = str(tmp_path / "store")
    assert load_fact(spark, target, csv1).collect()[0].enrolments == 1
    # "ignore" keeps the stored table; "overwrite" replaces it; no CSV just reads.
    assert load_fact(spark, target, csv2, mode="ignore").collect()[0].enrolments == 1
    assert load_fact(spark, target, csv2, mode="overwrite").collect()[0].enrolments == 2
    assert load_fact(spark, target).collect()[0].enrolments == 2
    with pytest.raises(Exception):
        load_fact(spark, target, csv1, mode="errorifexists")


def test_type_ties_follow_report_order_and_null_means_sort_last(spark):
    rates = _rates(
        spark,
        [
            ("A", "Special", 5.0, 3.0, 2.0),
            ("A", "State-funded secondary", 5.0, 3.0, 2.0),
            ("A", "State-funded primary", None, None, None),
            ("B", "Special", 7.0, 3.0, 4.0),
            ("B", "State-funded secondary", 7.0, 3.0, 4.0),
            ("A", "Total", 6.0, 3.0, 3.0),
        ],
    )
    gap = links.type_gap(rates).collect()[0]
    # Equal means: the highest is the earlier type, the lowest the later one.
    assert (gap.highest_type, gap.lowest_type, gap.gap) == ("Special", "State-funded secondary", 0.0)
    mv = links.most_variable_type(rates).collect()[0]
    assert mv.school_type == "Special"  # equal ranges: report order
    order = [r.school_type for r in links.type_averages(rates).collect()]
    assert order == ["Special", "State-funded secondary", "State-funded primary"]


def test_region_change_sign_and_worsened(make_fact):
    def row(region, period, rate):
        return {"time_period": period, "geographic_level": REG, "school_type": "Total",
                "region_name": region, "sess_overall_percent": rate}

    df = make_fact([row("A", 201213, 4.0), row("A", 201314, 4.5), row("B", 201213, 5.0), row("B", 201314, 5.0)])
    got = {r.region_name: r for r in regions.region_worsened(df).collect()}
    assert list(got) == ["A"] and got["A"].increase == 0.5 and got["A"].first_period == 4.0
    assert regions.region_improved(df).count() == 0
    assert regions.region_worst(df).collect()[0].region_name == "B"


def test_staged_tables_live_under_the_checkpoint_dir(spark, make_fact):
    from rollcall.session import ensure_checkpoint_dir, scratch_path
    from rollcall.sources import stage_fact

    base = spark.sparkContext.getCheckpointDir()
    assert base and ensure_checkpoint_dir(spark) == base
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/x-")
    staged = stage_fact(spark, make_fact([{"time_period": 201819, "geographic_level": NAT, "school_type": "Total"}]))
    from urllib.parse import urlparse

    root = urlparse(base).path.rstrip("/")
    assert staged.inputFiles() and all(urlparse(f).path.startswith(root + "/") for f in staged.inputFiles())


def _csv(path, columns, *rows):
    path.write_text(",".join(columns) + "\n" + "".join(",".join(r[c] for c in columns) + "\n" for r in rows))


def _csv_row(**values):
    from rollcall.schema import FACT_COLUMNS

    row = {c: "1" for c in FACT_COLUMNS}
    row.update({"time_period": "201819", "geographic_level": "National", "school_type": "Total", "region_name": "", "la_name": ""})
    return {**row, **values}


@pytest.mark.parametrize("cell,value", [("12.0", 12), ('"1,234"', 1234), (":", None), ("C", None), ("low", None), ("-7", -7)])
def test_csv_count_cells(spark, tmp_path, cell, value):
    from rollcall.schema import FACT_COLUMNS
    from rollcall.sources import read_fact_csv

    _csv(tmp_path / "f.csv", FACT_COLUMNS, _csv_row(num_schools=cell))
    assert [r.num_schools for r in read_fact_csv(spark, str(tmp_path / "f.csv")).collect()] == [value]


@pytest.mark.parametrize("column,cell", [("num_schools", "oops"), ("num_schools", "12.5"), ("sess_overall_percent", "4.5%")])
def test_csv_unknown_cells_raise(spark, tmp_path, column, cell):
    from rollcall.schema import FACT_COLUMNS
    from rollcall.sources import read_fact_csv

    _csv(tmp_path / "f.csv", FACT_COLUMNS, _csv_row(**{column: cell}))
    with pytest.raises(Exception, match=f"column {column}.*{cell}"):
        read_fact_csv(spark, str(tmp_path / "f.csv")).collect()


def test_csv_files_with_other_column_order_raise(spark, tmp_path):
    from rollcall.schema import FACT_COLUMNS
    from rollcall.sources import read_fact_csv

    swapped = list(FACT_COLUMNS)
    i, j = swapped.index("sess_possible"), swapped.index("sess_overall")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    folder = tmp_path / "many"
    folder.mkdir()
    _csv(folder / "a.csv", FACT_COLUMNS, _csv_row(sess_possible="10", sess_overall="3"))
    _csv(folder / "b.csv", FACT_COLUMNS, _csv_row(sess_possible="20", sess_overall="4"))
    df = read_fact_csv(spark, str(folder))
    assert sorted((r.sess_possible, r.sess_overall) for r in df.collect()) == [(10, 3), (20, 4)]
    _csv(folder / "c.csv", swapped, _csv_row(sess_possible="30", sess_overall="5"))
    with pytest.raises(Exception, match="header"):
        read_fact_csv(spark, str(folder)).collect()


def test_comparison_year_comes_from_data_or_caller(make_fact):
    from rollcall.plans import reports

    rows = [{"time_period": 201920, "geographic_level": LA, "school_type": "Total", "la_name": n, "num_schools": i}
            for i, n in enumerate("PQ")]
    df = make_fact(rows)
    basic = reports.compare_la(df, "P", "Q", 2019)["basic"].collect()
    assert (basic[0].value1, basic[0].value2) == (0.0, 1.0)
    with pytest.raises(ValueError, match="2006-2018"):
        reports.compare_la(df, "P", "Q", 2019, first_year=2006, last_year=2018)


def test_grain_check_finds_repeats(make_fact):
    df = make_fact([{"time_period": 201819, "school_type": t} for t in ("Total", "Special", "Special")])
    assert [(r.school_type, r.n) for r in check_grain(df).collect()] == [("Special", 2)]


def test_query_unique_and_first_row_agree_on_unique_groups(make_fact):
    df = make_fact([{"la_name": "A", "time_period": 1, "enrolments": 5}, {"la_name": "B", "time_period": 1, "enrolments": None}])
    args = {"fields": {"enrolments": "e", "num_schools": "n"}}
    assert sorted(query(df, "la_name", **args).collect()) == sorted(query(df, "la_name", unique=True, **args).collect())


def test_derivation_scopes(spark):
    from rollcall.schema import TOTAL
    from rollcall.sources import absence

    from .conftest import SF_SMALL

    whole = absence(spark, SF_SMALL)
    part = absence(spark, SF_SMALL, years=[2014, 2016], levels=[REG], school_types=[TOTAL])
    want = filter_fact(whole, year=[2014, 2016], geographic_level=REG, school_type=TOTAL)
    assert part.count() == want.count() > 0 and part.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        absence(spark, SF_SMALL, levels=["Planet"])


def test_checkpoint_folder_must_be_set_off_local_masters(spark, monkeypatch):
    from rollcall import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_folders_are_dropped(spark):
    import os

    from rollcall import session
    from rollcall.sources.fact_io import store_small

    kept = list(session._SCRATCH)
    session._SCRATCH.clear()
    try:
        df = store_small(spark.range(3).toDF("n"), "gone")
        assert df.count() == 3
        path = session._SCRATCH[0].replace("file:", "")
        assert os.path.isdir(path)
        session.drop_scratch(spark)
        assert not os.path.exists(path) and not session._SCRATCH
    finally:
        session._SCRATCH[:] = kept


def test_fixed_labels_by_value():
    """Literal values, so that a wrong mapping cannot agree with itself."""
    from rollcall import schema

    assert schema.FIELD_SETS["unauthorized"] == {
        "sess_unauthorised": "absences", "sess_unauth_late": "late", "sess_unauth_holiday": "holiday", "sess_unauth_other": "other",
        "sess_unauth_totalreasons": "total_reasons", "sess_unauthorised_pa_10_exact": "pa"}
    assert schema.FIELD_SETS["overall_percent"] == {
        "sess_overall_percent": "absences_percent", "sess_overall_percent_pa_10_exact": "pa_percent"}
    assert [c for _, c in schema.MAIN_REASONS] == [
        "sess_auth_illness", "sess_auth_appointments", "sess_auth_religious", "sess_auth_study", "sess_auth_traveller",
        "sess_auth_holiday", "sess_auth_excluded", "sess_auth_other", "sess_unauth_holiday", "sess_unauth_late",
        "sess_unauth_other", "sess_unauth_noyet"]
    assert schema.BASIC_METRICS[3:] == [
        ("Overall Absence Rate (%)", "sess_overall_percent", "rate"), ("Authorised Absence Rate (%)", "sess_authorised_percent", "rate"),
        ("Unauthorised Absence Rate (%)", "sess_unauthorised_percent", "rate"),
        ("Persistent Absentees (%)", "enrolments_pa_10_exact_percent", "rate")]
    assert [c for _, c in schema.UNAUTHORISED_METRICS] == [
        "sess_unauth_holiday", "sess_unauth_late", "sess_unauth_other", "sess_unauth_noyet"]
