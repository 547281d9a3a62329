"""Print the physical plans of the key queries.

    python tools/show_plans.py [sf_dir] > /tmp/plans.txt
    python tools/show_plans.py --md [sf_dir] > PLANS.md

Size-based broadcasting is switched off so that the plans are the ones a
large input gets (AQE off too, to show the static plan).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv) -> None:
    args = [a for a in argv[1:] if a != "--md"]
    if "--md" in argv:
        import contextlib
        import io

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            main([argv[0], *args])
        print(markdown(buf.getvalue(), args[0] if args else "/root/testdata/sf0.01"))
        return
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from rollcall.plans import links, places, regions
    from rollcall.session import local_session
    from rollcall.sources import absence, stage_fact

    spark = local_session(8, 8)
    fact = stage_fact(spark, absence(spark, sf_dir), "plans-fact")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rates = links.region_type_rates(fact, 2018)
    shown = {
        "fact derivation (star schema -> 39 columns)": absence(spark, sf_dir),
        "unauthorised by LA over the stored fact (pruning + pushdown)": places.unauthorised_by(fact, 2018, "la"),
        "page 2 (offset/limit, no global window)": places.unauthorised_page(fact, 2018, "la", 2, 10),
        "region change (one pass over the raw tables)": regions.region_change(
            absence(spark, sf_dir, levels=["Regional"], school_types=["Total"])),
        "one year of one level over the raw tables": places.unauthorised_by(
            absence(spark, sf_dir, years=[2018], levels=["Local authority"], school_types=["Total"]), 2018, "la"),
        "top regions per type (WindowGroupLimit)": links.top_regions_by_type(rates, 5),
    }
    for title, df in shown.items():
        print(f"### {title}\n")
        df.explain("formatted" if "derivation" not in title else "simple")
        print()
    spark.stop()


def markdown(text: str, sf_dir: str) -> str:
    import re

    sections = {s.split("\n", 1)[0]: s.split("\n", 1)[1] for s in text.split("### ")[1:]}

    def find(prefix: str) -> str:
        return next(v for k, v in sections.items() if k.startswith(prefix))

    def clip(block: str, n: int = 160) -> str:
        return "\n".join(line[:n] + (" …" if len(line) > n else "") for line in block.strip().splitlines())

    def pick(block: str, pats) -> str:
        return clip("\n".join(line for line in block.splitlines() if any(p in line for p in pats)), 170)

    derivation = re.sub(r"#\d+L?", "", find("fact derivation"))
    return f"""# Physical plans

Generated by `python tools/show_plans.py --md {sf_dir}` with size-based
broadcasting and AQE switched off, so the plans are the ones a large input
would get. Expression ids are removed and long lines clipped.

## Fact derivation (`sources/star.py`)

Read bottom-up: `lineitem` (4 columns read) is partially aggregated per order
before its shuffle; the join to `orders` reuses that partitioning (only
`orders` is shuffled); pupils are summed per (school, period) with a partial
aggregate before the shuffle; `customer` joins on its unique key with its
geography; one aggregate reaches the finest grain and the `Expand` of the six grouping sets runs over that small
table only. (With size-based broadcasting switched off, as here, the five-
and twenty-five-row geography tables shuffle to join each other; with the
default threshold the planner broadcasts them.)

```
{clip(derivation)}
```

## Report over the stored fact: partition pruning and pushed filters

```
{pick(find("unauthorised by LA"), ["PartitionFilters", "PushedFilters", "ReadSchema"])}
```

## Paging: `TakeOrderedAndProject`, no window, no single-partition exchange

```
{pick(find("page 2"), ["TakeOrderedAndProject", "Exchange", "Window"])}
```

## Region change over the raw tables: one scan of each table, bounds by a window over one row per region

```
{pick(find("region change"), ["Scan parquet", "Location", "PushedFilters", "Window"])}
```

## One year of one level over the raw tables: the year reaches the orders scan

```
{pick(find("one year"), ["Scan parquet", "PushedFilters", "LeftSemi", "Expand", "Join type"])}
```

## Top k per type: `WindowGroupLimit` before and after the shuffle

```
{pick(find("top regions"), ["WindowGroupLimit", "Exchange", "Window ("])}
```
"""


if __name__ == "__main__":
    main(sys.argv)
