"""Parameters of the registered queries (the checked scenarios)."""

YEARS_FILTER = [2016, 2018]
MEMBER_LEVELS = ["Regional", "National"]
FILTER_FACT = {
    "year": 2018,
    "geographic_level": "Local authority",
    "school_type": "Total",
    "region_name": "ASIA",
    "la_name": ["NATION_2", "NATION_7"],
}
PREFIXES = ["nation_1", "NATION_2"]
EXIST_VALUES = ["NATION_1", "NOWHERE"]
FIELDS_YEAR = 2018
PIVOT_LAS = ["NATION_1", "NATION_2"]
TYPE_SEARCH = {"school_type": "Special", "year": 2015}
UNAUTH_YEAR = 2018
PAGE = {"year": 2018, "by": "la", "page_number": 2, "page_size": 10}
COMPARE = {"la1": "NATION_1", "la2": "NATION_2", "year": 2015}
REASON_YEAR = 2018
LINK_YEAR = 2018
TOP_K = 3
# Keys that repeat (several school types share them).
GRAIN_WITHOUT_TYPE = ["time_period", "geographic_level", "region_name", "la_name"]
# (absences, name) of the last row seen; the page that follows it.
PAGE_AFTER = (1885, "NATION_15")
# A page deep in the sort of all local-authority rows by absence sessions.
RANKED = {"page_number": 9, "page_size": 25}
# Start years of the periods in the given tables (oracle columns only).
PERIOD_YEARS = [2012, 2013, 2014, 2015, 2016, 2017, 2018]
# The year that is loaded a second time into a stored table.
RELOADED_YEAR = 2016
# The year whose regional enrolments are spoilt in the rough CSV files.
SPOILT_YEAR = 2015
