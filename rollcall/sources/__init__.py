"""Sources and sinks: the fact table's CSV and Parquet forms, and its
derivation from the star-schema test tables."""

from . import catalogs, increment, periods, rank_index, star_store
from .csv_checked import read_checked
from .fact_io import load_fact, read_fact, read_fact_csv, stage_fact, write_fact, write_fact_csv
from .star import absence, derive_fact, read_star

__all__ = [
    "absence",
    "catalogs",
    "derive_fact",
    "increment",
    "load_fact",
    "periods",
    "rank_index",
    "read_checked",
    "read_fact",
    "read_fact_csv",
    "read_star",
    "stage_fact",
    "star_store",
    "write_fact",
    "write_fact_csv",
]
