"""Every command of the command line, on the smallest tables."""

from __future__ import annotations

import pytest

from rollcall.cli import main

from .conftest import SF_SMALL

COMMANDS = [
    (["search_la", "--las", "NATION_1,NATION_2", "--prefixes", "nation_1"], ["== enrolments", "NATION_2"]),
    (["search_type", "--type", "Special", "--year", "2015"], ["== authorised", "== breakdown", "illness"]),
    (["search_unauth", "--year", "2018", "--by", "la", "--page", "2"], ["== rows", "== page", "absences"]),
    (["compare_la", "--la1", "NATION_1", "--la2", "NATION_2", "--year", "2015"], ["== summary", "better_attendance"]),
    (["region_chart"], ["== trends", "== best", "avg_absence"]),
    (["explore_link", "--year", "2018", "--k", "2"], ["== findings", "worst_region_total", "== chart_heatmap"]),
]


@pytest.mark.parametrize("argv,expected", COMMANDS, ids=[c[0][0] for c in COMMANDS])
def test_command(spark, capsys, argv, expected):
    assert main(["--star", SF_SMALL, "--rows", "5", *argv]) == 0
    out = capsys.readouterr().out
    for text in expected:
        assert text in out


def test_store_then_read(spark, tmp_path, capsys):
    from rollcall.sources import absence, write_fact_csv

    csv = write_fact_csv(absence(spark, SF_SMALL), str(tmp_path / "fact.csv"))
    out_dir = str(tmp_path / "stored")
    assert main(["store", "--csv", csv, "--out", out_dir]) == 0
    assert main(["--fact", out_dir, "--rows", "3", "region_chart"]) == 0
    assert "== worst" in capsys.readouterr().out


def test_explain_prints_plans(spark, capsys):
    assert main(["--star", SF_SMALL, "--explain", "search_unauth", "--year", "2018", "--by", "la"]) == 0
    out = capsys.readouterr().out
    assert "== page" in out and "TakeOrderedAndProject" in out and "PartitionFilters" in out


@pytest.mark.parametrize("rows", [4, 7])
def test_rows_limits_what_is_printed(spark, capsys, rows):
    assert main(["--star", SF_SMALL, "--rows", str(rows), "search_unauth", "--year", "2018", "--by", "la", "--page-size", "20"]) == 0
    page = capsys.readouterr().out.split("== page")[1].split("==")[0]
    assert sum("NATION_" in line for line in page.splitlines()) == rows  # of 20
    assert f"only showing top {rows} rows" in page
