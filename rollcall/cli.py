"""Command line: run one report and print its result tables.

    python -m rollcall --fact PATH region_chart
    python -m rollcall --star /root/testdata/sf0.01 compare_la --la1 NATION_1 --la2 NATION_2 --year 2015
    python -m rollcall store --csv absence.csv --out /shared/fact

``--fact`` reads a stored Parquet fact table; ``--star`` derives it from the
star-schema tables and stores it under ``spark.checkpoint.dir`` first. Under
``spark-submit`` the cluster's session is used.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _split(text: str | None) -> list[str]:
    return [t.strip() for t in (text or "").split(",") if t.strip()]


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rollcall", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = p.add_mutually_exclusive_group()
    src.add_argument("--fact", help="stored Parquet fact table")
    src.add_argument("--star", help="directory of star-schema Parquet tables")
    p.add_argument("--rows", type=int, default=50, help="rows to print per table")
    p.add_argument("--explain", action="store_true", help="print each result's physical plan instead of its rows")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("search_la", help="enrolments by period for chosen local authorities")
    s.add_argument("--las", required=True, help="comma-separated local authorities")
    s.add_argument("--prefixes", default="", help="comma-separated name prefixes")
    s = sub.add_parser("search_type", help="national authorised absence for a school type and year")
    s.add_argument("--type", required=True, dest="school_type")
    s.add_argument("--year", required=True)
    s = sub.add_parser("search_unauth", help="unauthorised absence in a year by region or LA, paged")
    s.add_argument("--year", required=True)
    s.add_argument("--by", choices=["region", "la"], default="region")
    s.add_argument("--page", type=int, default=1)
    s.add_argument("--page-size", type=int, default=10)
    s = sub.add_parser("compare_la", help="two local authorities side by side in one year")
    s.add_argument("--la1", required=True)
    s.add_argument("--la2", required=True)
    s.add_argument("--year", required=True)
    s.add_argument("--first-year", type=int, default=None, help="earliest year to accept")
    s.add_argument("--last-year", type=int, default=None, help="latest year to accept")
    sub.add_parser("region_chart", help="regional absence over time: trends, best and worst")
    s = sub.add_parser("explore_link", help="school type x region in one year")
    s.add_argument("--year", default=None)
    s.add_argument("--k", type=int, default=5)
    s = sub.add_parser("store", help="read a published CSV and store it as Parquet")
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "ignore"])
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    from .plans import reports
    from .session import drop_scratch
    from .sources import absence, read_fact, read_fact_csv, stage_fact, write_fact

    spark = SparkSession.builder.appName("rollcall").getOrCreate()
    if args.command == "store":
        write_fact(read_fact_csv(spark, args.csv), args.out, mode=args.mode)
        print(f"stored {args.out}")
        return 0
    if args.fact:
        fact = read_fact(spark, args.fact)
    elif args.star:
        # Derive once and store under the checkpoint folder; every result
        # table of the report then reads the stored table.
        fact = stage_fact(spark, absence(spark, args.star), "cli-fact")
    else:
        print("give --fact or --star", file=sys.stderr)
        return 2

    c = args.command
    if c == "search_la":
        out = reports.search_la(fact, _split(args.las), _split(args.prefixes))
    elif c == "search_type":
        out = reports.search_type(fact, args.school_type, args.year)
    elif c == "search_unauth":
        out = reports.search_unauth(fact, args.year, args.by, args.page, args.page_size)
    elif c == "compare_la":
        out = reports.compare_la(fact, args.la1, args.la2, args.year, args.first_year, args.last_year)
    elif c == "region_chart":
        out = reports.region_chart(fact)
    else:
        out = reports.explore_link(fact, args.year, args.k)
    for name, df in out.items():
        print(f"== {name}")
        if args.explain:
            df.explain("formatted")
        else:
            total = df.count()
            df.show(args.rows, truncate=False)
            print(f"{min(args.rows, total)} of {total} rows")
    drop_scratch(spark)
    return 0
