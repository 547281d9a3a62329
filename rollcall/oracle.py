"""DuckDB oracle SQL for every registered query.

Each oracle starts from ``ABSENCE_CTE``: the fact table derived from the
star-schema views in plain SQL (window for the persistent-absence test,
GROUPING SETS with COUNT(DISTINCT)) -- deliberately the naive formulation, so
that it checks the pre-aggregated Spark plan in :mod:`rollcall.sources.star`
rather than repeating it. Column names and types match the Spark results.
"""

from __future__ import annotations

from .schema import (
    AUTHORISED_METRICS,
    BASIC_METRICS,
    FIELD_SETS,
    MAIN_REASONS,
    SCHOOL_TYPES,
    UNAUTHORISED_METRICS,
)

ABSENCE_CTE = """WITH base AS (
 SELECT CAST((year(o.o_orderdate)+17)*100 + (year(o.o_orderdate)+18)%100 AS INT) AS time_period,
  r.r_name AS region_name, n.n_name AS la_name,
  CASE WHEN c.c_mktsegment IN ('AUTOMOBILE','HOUSEHOLD') THEN 'State-funded primary'
       WHEN c.c_mktsegment IN ('BUILDING','MACHINERY') THEN 'State-funded secondary' ELSE 'Special' END AS school_type,
  o.o_orderkey AS pupil, c.c_custkey AS school, CAST(l.l_quantity AS BIGINT) AS q, l.l_returnflag AS f,
  concat(substr(o.o_orderpriority,1,1), l.l_linestatus) AS rc,
  sum(CASE WHEN l.l_returnflag IN ('A','R') THEN l.l_quantity ELSE 0 END) OVER (PARTITION BY o.o_orderkey) * 10
    >= sum(l.l_quantity) OVER (PARTITION BY o.o_orderkey) * 8 AS pa
 FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
 JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN region r ON n.n_regionkey=r.r_regionkey),
cube AS (SELECT time_period,
 CASE WHEN GROUPING(region_name)=1 THEN 'National' WHEN GROUPING(la_name)=1 THEN 'Regional' ELSE 'Local authority' END AS geographic_level,
 region_name, la_name, CASE WHEN GROUPING(school_type)=1 THEN 'Total' ELSE school_type END AS school_type,
 count(DISTINCT school) AS num_schools, count(DISTINCT pupil) AS enrolments, count(DISTINCT CASE WHEN pa THEN pupil END) AS enrolments_pa_10_exact,
 CAST(sum(q) AS BIGINT) AS sess_possible,
 CAST(sum(CASE WHEN f IN ('A','R') THEN q ELSE 0 END) AS BIGINT) AS sess_overall,
 CAST(sum(CASE WHEN f='A' THEN q ELSE 0 END) AS BIGINT) AS sess_authorised,
 CAST(sum(CASE WHEN f='R' THEN q ELSE 0 END) AS BIGINT) AS sess_unauthorised,
 CAST(sum(CASE WHEN f IN ('A','R') THEN q ELSE 0 END) AS BIGINT) AS sess_overall_totalreasons,
 CAST(sum(CASE WHEN f='A' THEN q ELSE 0 END) AS BIGINT) AS sess_auth_totalreasons,
 CAST(sum(CASE WHEN f='R' THEN q ELSE 0 END) AS BIGINT) AS sess_unauth_totalreasons,
 CAST(sum(CASE WHEN pa THEN q ELSE 0 END) AS BIGINT) AS sess_possible_pa_10_exact,
 CAST(sum(CASE WHEN pa AND f IN ('A','R') THEN q ELSE 0 END) AS BIGINT) AS sess_overall_pa_10_exact,
 CAST(sum(CASE WHEN pa AND f='A' THEN q ELSE 0 END) AS BIGINT) AS sess_authorised_pa_10_exact,
 CAST(sum(CASE WHEN pa AND f='R' THEN q ELSE 0 END) AS BIGINT) AS sess_unauthorised_pa_10_exact,
 CAST(sum(CASE WHEN f='A' AND rc IN ('1F','1O') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_illness,
 CAST(sum(CASE WHEN f='A' AND rc IN ('2F') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_appointments,
 CAST(sum(CASE WHEN f='A' AND rc IN ('2O') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_religious,
 CAST(sum(CASE WHEN f='A' AND rc IN ('3F') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_study,
 CAST(sum(CASE WHEN f='A' AND rc IN ('3O') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_traveller,
 CAST(sum(CASE WHEN f='A' AND rc IN ('4F') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_holiday,
 CAST(sum(CASE WHEN f='A' AND rc IN ('4O') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_ext_holiday,
 CAST(sum(CASE WHEN f='A' AND rc IN ('5F') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_excluded,
 CAST(sum(CASE WHEN f='A' AND rc IN ('5O') THEN q ELSE 0 END) AS BIGINT) AS sess_auth_other,
 CAST(sum(CASE WHEN f='R' AND rc IN ('1F','1O') THEN q ELSE 0 END) AS BIGINT) AS sess_unauth_late,
 CAST(sum(CASE WHEN f='R' AND rc IN ('2F','2O') THEN q ELSE 0 END) AS BIGINT) AS sess_unauth_holiday,
 CAST(sum(CASE WHEN f='R' AND rc IN ('3F','3O','5F','5O') THEN q ELSE 0 END) AS BIGINT) AS sess_unauth_other,
 CAST(sum(CASE WHEN f='R' AND rc IN ('4F','4O') THEN q ELSE 0 END) AS BIGINT) AS sess_unauth_noyet
FROM base GROUP BY GROUPING SETS ((time_period),(time_period,school_type),(time_period,region_name),(time_period,region_name,school_type),
 (time_period,region_name,la_name),(time_period,region_name,la_name,school_type))),
absence AS (SELECT *, 100.0*CAST(enrolments_pa_10_exact AS DOUBLE)/enrolments AS enrolments_pa_10_exact_percent,
 100.0*CAST(sess_overall AS DOUBLE)/sess_possible AS sess_overall_percent,
 100.0*CAST(sess_authorised AS DOUBLE)/sess_possible AS sess_authorised_percent,
 100.0*CAST(sess_unauthorised AS DOUBLE)/sess_possible AS sess_unauthorised_percent,
 100.0*CAST(sess_overall_pa_10_exact AS DOUBLE)/nullif(sess_possible_pa_10_exact,0) AS sess_overall_percent_pa_10_exact,
 100.0*CAST(sess_authorised_pa_10_exact AS DOUBLE)/nullif(sess_possible_pa_10_exact,0) AS sess_authorised_percent_pa_10_exact,
 100.0*CAST(sess_unauthorised_pa_10_exact AS DOUBLE)/nullif(sess_possible_pa_10_exact,0) AS sess_unauthorised_percent_pa_10_exact
 FROM cube)
"""

from . import params as P  # noqa: E402


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _with(select: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"{ABSENCE_CTE}{extra}\n{select}"


def _years(years, column: str = "time_period") -> str:
    ys = [years] if isinstance(years, (int, str)) else list(years)
    return "(" + " OR ".join(f"{column} BETWEEN {int(y) * 100} AND {int(y) * 100 + 99}" for y in ys) + ")"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _type_order(column: str = "school_type") -> str:
    whens = " ".join(f"WHEN {_q(t)} THEN {i + 1}" for i, t in enumerate(SCHOOL_TYPES))
    return f"CAST(CASE {column} {whens} ELSE 0 END AS INTEGER)"


def _main_reason() -> str:
    cols = [c for _, c in MAIN_REASONS]
    g = "greatest(" + ", ".join(cols) + ")"
    whens = " ".join(f"WHEN {c} = {g} THEN {_q(label)}" for label, c in MAIN_REASONS)
    return f"CASE {whens} END"


def _fields(fields: dict[str, str]) -> str:
    return ", ".join(f"{src} AS {alias}" for src, alias in fields.items())


def _pct(col: str) -> str:
    return f"coalesce(CAST({col} AS DOUBLE) / nullif(CAST(sess_possible AS DOUBLE), 0) * 100, 0.0)"


def _compare(metrics: list[tuple[str, str, str]]) -> str:
    """metrics: (label, SQL value expression, kind)."""
    la1, la2 = _q(P.COMPARE["la1"]), _q(P.COMPARE["la2"])
    parts = [
        f"SELECT CAST({i + 1} AS INTEGER) AS metric_order, {_q(label)} AS metric, {_q(kind)} AS kind, "
        f"max(CASE WHEN la_name = {la1} THEN CAST({expr} AS DOUBLE) END) AS value1, "
        f"max(CASE WHEN la_name = {la2} THEN CAST({expr} AS DOUBLE) END) AS value2 FROM cmp"
        for i, (label, expr, kind) in enumerate(metrics)
    ]
    m = "m AS (" + "\nUNION ALL ".join(parts) + ")"
    select = (
        "SELECT metric_order, metric, kind, value1, value2, value1 - value2 AS diff, "
        "CASE WHEN kind <> 'rate' THEN NULL WHEN value1 - value2 = 0 THEN 'same' "
        "WHEN value1 - value2 < 0 THEN 'better' WHEN value1 - value2 > 0 THEN 'worse' END AS indicator FROM m"
    )
    return _with(select, _cmp(), m)


def _cmp() -> str:
    return (
        "cmp AS (SELECT * FROM absence WHERE "
        f"{_years(P.COMPARE['year'])} AND geographic_level = 'Local authority' AND school_type = 'Total' "
        f"AND la_name IN {_in([P.COMPARE['la1'], P.COMPARE['la2']])})"
    )


_REGIONAL = (
    "r AS (SELECT region_name, time_period, sess_overall_percent, sess_authorised_percent, "
    "sess_unauthorised_percent FROM absence WHERE geographic_level = 'Regional' AND school_type = 'Total')"
)
_CHANGE = (
    "b AS (SELECT min(time_period) AS lo, max(time_period) AS hi FROM r)",
    "c0 AS (SELECT region_name, round(max(CASE WHEN time_period = b.lo THEN sess_overall_percent END), 4) AS first_period, "
    "round(max(CASE WHEN time_period = b.hi THEN sess_overall_percent END), 4) AS last_period, "
    "round(avg(sess_overall_percent), 4) AS avg_absence FROM r, b GROUP BY region_name)",
    "c1 AS (SELECT region_name, first_period, last_period, round(last_period - first_period, 4) AS change, avg_absence FROM c0)",
    "c AS (SELECT *, CASE WHEN change = 0 THEN 'same' WHEN change < 0 THEN 'better' WHEN change > 0 THEN 'worse' END "
    "AS indicator FROM c1)",
)
def _rates(when: str | None = None) -> str:
    return (
        "t AS (SELECT region_name, school_type, avg(sess_overall_percent) AS overall_absence_rate, "
        "avg(sess_authorised_percent) AS authorised_absence_rate, avg(sess_unauthorised_percent) AS unauthorised_absence_rate "
        f"FROM absence WHERE geographic_level = 'Regional' AND school_type IN {_in(SCHOOL_TYPES)} "
        f"AND {when or _years(P.LINK_YEAR)} GROUP BY region_name, school_type)"
    )


_RANKED = (
    "rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY school_type ORDER BY overall_absence_rate DESC NULLS LAST, "
    "region_name) AS INTEGER) AS rank FROM t)"
)
_MEANS = (
    "tm AS (SELECT school_type, avg(overall_absence_rate) AS overall_absence_rate, "
    "avg(authorised_absence_rate) AS authorised_absence_rate, avg(unauthorised_absence_rate) AS unauthorised_absence_rate, "
    f"{_type_order()} AS type_order FROM t GROUP BY school_type)"
)
_RANGES = (
    "rr0 AS (SELECT *, row_number() OVER (PARTITION BY school_type ORDER BY overall_absence_rate ASC, region_name) AS lo_rn, "
    "row_number() OVER (PARTITION BY school_type ORDER BY overall_absence_rate DESC, region_name) AS hi_rn "
    "FROM t WHERE school_type <> 'Total' AND overall_absence_rate IS NOT NULL)",
    "rr AS (SELECT school_type, max(CASE WHEN lo_rn = 1 THEN region_name END) AS lowest_region, "
    "min(overall_absence_rate) AS lowest_rate, max(CASE WHEN hi_rn = 1 THEN region_name END) AS highest_region, "
    "max(overall_absence_rate) AS highest_rate, max(overall_absence_rate) - min(overall_absence_rate) AS diff, "
    f"{_type_order()} AS type_order FROM rr0 GROUP BY school_type)",
)
_BARS = (
    "bars AS (SELECT region_name, "
    + ", ".join(
        f"coalesce(max(CASE WHEN school_type = {_q(s)} THEN overall_absence_rate END), 0.0) AS \"{s}\""
        for s in SCHOOL_TYPES[1:]
    )
    + " FROM t GROUP BY region_name)"
)


def _consistent(min_types: int) -> str:
    return _with(
        "SELECT region_name, count(*) AS n_types, string_agg(school_type, ', ' ORDER BY type_order) AS school_types "
        f"FROM h GROUP BY region_name HAVING count(*) >= {min_types}",
        _rates(),
        _RANKED,
        f"h AS (SELECT region_name, school_type, {_type_order()} AS type_order FROM rk WHERE rank = 1 AND school_type <> 'Total')",
    )


def oracle_sql() -> dict[str, str]:
    lvl_la = "geographic_level = 'Local authority' AND school_type = 'Total'"
    out: dict[str, str] = {}
    out["build_fact"] = _with("SELECT * FROM absence")
    spoilt = f"geographic_level = 'Regional' AND {_years(P.SPOILT_YEAR)}"
    out["csv_accepted"] = _with(f"SELECT * FROM absence WHERE NOT ({spoilt})")
    out["csv_rejects"] = _with(
        "SELECT 'enrolments' AS \"column\", CAST(enrolments AS VARCHAR) || '?' AS text, count(*) AS n "
        f"FROM absence WHERE {spoilt} GROUP BY enrolments"
    )
    for name in ("fact_by_periods", "fact_of_stored_star", "fact_of_increments"):
        out[name] = out["build_fact"]
    out["fact_one_per_key"] = _with(
        "SELECT geographic_level, count(*) AS stored, CASE WHEN geographic_level = 'Regional' THEN count(*) ELSE 0 END AS kept_out "
        "FROM absence GROUP BY geographic_level"
    )
    out["check_grain"] = _with(
        "SELECT time_period, geographic_level, region_name, la_name, school_type, count(*) AS n FROM absence "
        "GROUP BY time_period, geographic_level, region_name, la_name, school_type HAVING count(*) > 1"
    )
    out["check_grain_repeats"] = _with(
        f"SELECT {', '.join(P.GRAIN_WITHOUT_TYPE)}, count(*) AS n FROM absence "
        f"GROUP BY {', '.join(P.GRAIN_WITHOUT_TYPE)} HAVING count(*) > 1"
    )
    out["filter_year"] = _with(f"SELECT * FROM absence WHERE {_years(P.YEARS_FILTER)}")
    out["filter_members"] = _with(f"SELECT * FROM absence WHERE geographic_level IN {_in(P.MEMBER_LEVELS)}")
    ff = dict(P.FILTER_FACT)
    kept = [_years(ff.pop("year"))] if "year" in ff else []
    kept += [f"{c} IN {_in([v] if isinstance(v, str) else v)}" for c, v in ff.items()]
    out["filter_fact"] = _with(f"SELECT * FROM absence WHERE {' AND '.join(kept)}")
    for name, col in [("catalog_la", "la_name"), ("catalog_school_types", "school_type"), ("catalog_regions", "region_name")]:
        out[name] = _with(f"SELECT DISTINCT {col} FROM absence WHERE {col} IS NOT NULL")
    out["catalog_size"] = _with(
        "SELECT count(DISTINCT la_name) AS n_la_name, count(DISTINCT school_type) AS n_school_type, "
        "count(DISTINCT region_name) AS n_region_name FROM absence"
    )
    first = (P.RANKED["page_number"] - 1) * P.RANKED["page_size"]
    out["ranked_page"] = _with(
        "SELECT * FROM (SELECT la_name, time_period, school_type, sess_overall, enrolments, row_number() OVER "
        "(ORDER BY sess_overall DESC NULLS LAST, la_name, time_period, school_type) AS rank "
        "FROM absence WHERE geographic_level = 'Local authority') "
        f"WHERE rank > {first} AND rank <= {first + P.RANKED['page_size']}"
    )
    out["la_enrolment_map"] = _with(
        "SELECT time_period, school_type, count(*) AS n_las, string_agg(la_name || '=' || CAST(enrolments AS VARCHAR), ';' ORDER BY la_name) "
        "AS enrolments FROM absence WHERE geographic_level = 'Local authority' GROUP BY time_period, school_type"
    )
    out["stored_catalog_la"] = _with("SELECT la_name, count(*) AS rows FROM absence WHERE la_name IS NOT NULL GROUP BY la_name")
    out["stored_catalog_size"] = out["catalog_size"]
    prefixes = sorted({p.strip().lower() for p in P.PREFIXES})
    out["search_prefix"] = _with(
        "SELECT p.prefix, a.la_name FROM (SELECT DISTINCT la_name FROM absence WHERE la_name IS NOT NULL) a "
        f"JOIN (VALUES {', '.join('(' + _q(p) + ')' for p in prefixes)}) p(prefix) ON starts_with(lower(a.la_name), p.prefix)"
    )
    out["search_prefix_empty"] = _with(
        "SELECT CAST(NULL AS VARCHAR) AS prefix, la_name FROM (SELECT DISTINCT la_name FROM absence "
        "WHERE la_name IS NOT NULL) ORDER BY la_name LIMIT 10"
    )
    out["members_exist"] = _with(
        "SELECT v.value, EXISTS (SELECT 1 FROM absence WHERE la_name = v.value) AS present "
        f"FROM (VALUES {', '.join('(' + _q(v) + ')' for v in P.EXIST_VALUES)}) v(value)"
    )
    for set_name, fields in FIELD_SETS.items():
        out[f"fields_{set_name}"] = _with(
            f"SELECT la_name, {_fields(fields)} FROM absence WHERE {lvl_la} AND {_years(P.FIELDS_YEAR)}"
        )
    out["la_enrolment_pivot"] = _with(
        "SELECT time_period, "
        + ", ".join(f"max(CASE WHEN la_name = {_q(la)} THEN enrolments END) AS \"{la}\"" for la in P.PIVOT_LAS)
        + f" FROM absence WHERE {lvl_la} AND la_name IN {_in(P.PIVOT_LAS)} GROUP BY time_period"
    )
    st, sy = P.TYPE_SEARCH["school_type"], P.TYPE_SEARCH["year"]
    national = f"{_years(sy)} AND geographic_level = 'National' AND school_type = {_q(st)}"
    out["school_type_authorised"] = _with(
        f"SELECT time_period, max(CASE WHEN school_type = {_q(st)} THEN sess_authorised END) AS \"{st}\" "
        f"FROM absence WHERE {national} GROUP BY time_period"
    )
    out["school_type_breakdown"] = _with(
        f"SELECT time_period, {_fields(FIELD_SETS['authorized'])} FROM absence WHERE {national}"
    )
    unauth = _fields(FIELD_SETS["unauthorized"])
    out["unauthorised_by_region"] = _with(
        f"SELECT region_name, {unauth} FROM absence WHERE geographic_level = 'Regional' "
        f"AND school_type = 'Total' AND {_years(P.UNAUTH_YEAR)}"
    )
    out["unauthorised_by_la"] = _with(f"SELECT la_name, {unauth} FROM absence WHERE {lvl_la} AND {_years(P.UNAUTH_YEAR)}")
    out["year_of_stored_star"] = out["unauthorised_by_la"]
    pg = P.PAGE
    key, level = ("la_name", "Local authority") if pg["by"] == "la" else ("region_name", "Regional")
    paged = f"geographic_level = {_q(level)} AND school_type = 'Total' AND {_years(pg['year'])}"
    last, last_name = P.PAGE_AFTER
    out["page_after"] = _with(
        f"SELECT * FROM (SELECT {key}, {unauth} FROM absence WHERE {paged}) "
        f"WHERE absences < {last} OR (absences = {last} AND {key} > {_q(last_name)}) OR absences IS NULL "
        f"ORDER BY absences DESC NULLS LAST, {key} LIMIT {pg['page_size']}"
    )
    out["page"] = _with(
        f"SELECT {key}, {unauth} FROM absence WHERE {paged} ORDER BY absences DESC NULLS LAST, {key} "
        f"LIMIT {pg['page_size']} OFFSET {(pg['page_number'] - 1) * pg['page_size']}"
    )
    out["unauthorised_row_count"] = _with(f"SELECT count(*) AS rows FROM absence WHERE {paged}")
    out["compare_basic"] = _compare([(label, c, kind) for label, c, kind in BASIC_METRICS])
    out["compare_authorised"] = _compare([(label, _pct(c), "rate") for label, c in AUTHORISED_METRICS])
    out["compare_unauthorised"] = _compare([(label, _pct(c), "rate") for label, c in UNAUTHORISED_METRICS])
    la1, la2 = _q(P.COMPARE["la1"]), _q(P.COMPARE["la2"])
    out["compare_verdicts"] = _with(
        f"SELECT {la1} AS place1, {la2} AS place2, "
        f"CASE WHEN o1 < o2 THEN {la1} WHEN o1 >= o2 THEN {la2} END AS better_attendance, "
        f"CASE WHEN p1 < p2 THEN {la1} WHEN p1 >= p2 THEN {la2} END AS lower_persistent_absence, "
        "r1 AS main_reason1, r2 AS main_reason2 FROM ("
        f"SELECT max(CASE WHEN la_name = {la1} THEN sess_overall_percent END) AS o1, "
        f"max(CASE WHEN la_name = {la2} THEN sess_overall_percent END) AS o2, "
        f"max(CASE WHEN la_name = {la1} THEN enrolments_pa_10_exact_percent END) AS p1, "
        f"max(CASE WHEN la_name = {la2} THEN enrolments_pa_10_exact_percent END) AS p2, "
        f"max(CASE WHEN la_name = {la1} THEN {_main_reason()} END) AS r1, "
        f"max(CASE WHEN la_name = {la2} THEN {_main_reason()} END) AS r2 FROM cmp) v",
        _cmp(),
    )
    out["main_absence_reason"] = _with(
        f"SELECT la_name, {_main_reason()} AS main_reason FROM absence WHERE {lvl_la} AND {_years(P.REASON_YEAR)}"
    )
    out["region_rates"] = _with("SELECT * FROM r", _REGIONAL)
    # A fixed column per period of the given tables: a view cannot hold a pivot
    # on values found at run time. A further period shows up as a column that
    # only the Spark side has.
    by_period = [(str(y * 100 + (y + 1) % 100), str(y)) for y in P.PERIOD_YEARS]
    rate = "max(CASE WHEN time_period = {p} THEN sess_overall_percent END)"
    pivoted = ", ".join(f'{rate.format(p=p)} AS "{p}"' for p, _ in by_period)
    out["region_overall_pivot"] = _with(f"SELECT region_name, {pivoted} FROM r GROUP BY region_name", _REGIONAL)
    rounded = ", ".join(f'round({rate.format(p=p)}, 2) AS "{label}"' for p, label in by_period)
    out["region_overall_rounded"] = _with(f"SELECT region_name, {rounded} FROM r GROUP BY region_name", _REGIONAL)
    out["region_average"] = _with(
        "SELECT region_name, round(avg(sess_overall_percent), 4) AS avg_absence FROM r GROUP BY region_name", _REGIONAL
    )
    out["region_change"] = _with("SELECT * FROM c", _REGIONAL, *_CHANGE)
    out["region_improved"] = _with("SELECT *, abs(change) AS decrease FROM c WHERE change < 0", _REGIONAL, *_CHANGE)
    out["region_worsened"] = _with("SELECT *, change AS increase FROM c WHERE change > 0", _REGIONAL, *_CHANGE)
    avg_cte = "a AS (SELECT region_name, round(avg(sess_overall_percent), 4) AS avg_absence FROM r GROUP BY region_name)"
    out["region_best"] = _with(
        "SELECT * FROM a ORDER BY avg_absence ASC NULLS LAST, region_name LIMIT 1", _REGIONAL, avg_cte
    )
    out["region_worst"] = _with(
        "SELECT * FROM a ORDER BY avg_absence DESC NULLS LAST, region_name LIMIT 1", _REGIONAL, avg_cte
    )
    rates_cols = "overall_absence_rate, authorised_absence_rate, unauthorised_absence_rate"
    out["region_type_rates"] = _with("SELECT * FROM t", _rates())
    out["region_type_rates_latest"] = _with(
        "SELECT * FROM t",
        _rates("time_period = (SELECT max(time_period) FROM absence WHERE geographic_level = 'Regional')"),
    )
    out["top_regions_by_type"] = _with(
        f"SELECT school_type, rank, region_name, {rates_cols} FROM rk WHERE rank <= {P.TOP_K}", _rates(), _RANKED
    )
    out["highest_by_type"] = _with(
        f"SELECT school_type, region_name, {rates_cols} FROM rk WHERE rank = 1", _rates(), _RANKED
    )
    out["type_averages"] = _with(
        "SELECT school_type, round(overall_absence_rate, 4) AS overall_absence_rate, "
        "round(authorised_absence_rate, 4) AS authorised_absence_rate, "
        "round(unauthorised_absence_rate, 4) AS unauthorised_absence_rate, type_order FROM tm WHERE school_type <> 'Total'",
        _rates(),
        _MEANS,
    )
    out["type_gap"] = _with(
        "SELECT (SELECT school_type FROM g ORDER BY overall_absence_rate DESC, type_order ASC LIMIT 1) AS highest_type, "
        "(SELECT school_type FROM g ORDER BY overall_absence_rate ASC, type_order DESC LIMIT 1) AS lowest_type, "
        "(SELECT round(max(overall_absence_rate) - min(overall_absence_rate), 4) FROM g) AS gap",
        _rates(),
        _MEANS,
        "g AS (SELECT * FROM tm WHERE school_type <> 'Total' AND overall_absence_rate IS NOT NULL)",
    )
    out["region_range_by_type"] = _with("SELECT * FROM rr", _rates(), *_RANGES)
    out["most_variable_type"] = _with(
        "SELECT school_type, diff AS variation FROM rr ORDER BY diff DESC, type_order ASC LIMIT 1", _rates(), *_RANGES
    )
    out["consistent_regions"] = _consistent(2)
    out["consistent_regions_min1"] = _consistent(1)
    sec, pri = _q("State-funded secondary"), _q("State-funded primary")
    out["phase_unauth_gap"] = _with(
        "SELECT round(sec, 4) AS secondary_unauth, round(pri, 4) AS primary_unauth, round(sec - pri, 4) AS gap, "
        "sec > pri AS secondary_higher FROM ("
        f"SELECT coalesce(max(CASE WHEN school_type = {sec} THEN unauthorised_absence_rate END), 0.0) AS sec, "
        f"coalesce(max(CASE WHEN school_type = {pri} THEN unauthorised_absence_rate END), 0.0) AS pri FROM tm) v",
        _rates(),
        _MEANS,
    )
    out["key_findings"] = _with(
        "SELECT (SELECT school_type FROM rr ORDER BY diff DESC, type_order ASC LIMIT 1) AS most_variable_type, "
        "(SELECT max(diff) FROM rr) AS variation, "
        f"(SELECT round(coalesce(max(CASE WHEN school_type = {sec} THEN unauthorised_absence_rate END), 0.0) - "
        f"coalesce(max(CASE WHEN school_type = {pri} THEN unauthorised_absence_rate END), 0.0), 4) FROM tm) "
        "AS secondary_minus_primary_unauth, "
        "(SELECT round(max(CASE WHEN school_type = 'Special' THEN overall_absence_rate END), 4) FROM tm) AS special_mean_overall, "
        "(SELECT region_name FROM rk WHERE school_type = 'Total' AND rank = 1) AS worst_region_total",
        _rates(),
        _RANKED,
        _MEANS,
        *_RANGES,
    )
    out["chart_region_trend"] = _with(
        "SELECT region_name, time_period, sess_overall_percent AS absence_rate FROM r", _REGIONAL
    )
    out["chart_region_type"] = _with("SELECT * FROM bars", _rates(), _BARS)
    out["chart_type_auth_unauth"] = _with(
        "SELECT school_type, type_order, round(authorised_absence_rate, 4) AS authorised, "
        "round(unauthorised_absence_rate, 4) AS unauthorised FROM tm",
        _rates(),
        _MEANS,
    )
    out["chart_heatmap"] = _with(
        "\nUNION ALL ".join(
            f"SELECT region_name, {_q(s)} AS school_type, \"{s}\" AS absence_rate FROM bars" for s in SCHOOL_TYPES[1:]
        ),
        _rates(),
        _BARS,
    )
    out["load_roundtrip"] = _with("SELECT * FROM absence")
    out["load_fact"] = _with("SELECT * FROM absence")
    return out
