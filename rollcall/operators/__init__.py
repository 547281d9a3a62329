"""DataFrame -> DataFrame operators. All lazy; none collects or creates a session."""

from .catalog import catalog, catalog_size, has_any, members_exist, search_prefix
from .compare import compare_metrics, lower_wins
from .filters import filter_fact, filter_members, filter_year
from .grouped import pick, query, resolve_fields
from .joins import join_dimension
from .paging import page, page_after, row_count
from .pivot_map import map_cells, map_columns, pivot_map
from .ranking import check_grain, top_k_per_group

__all__ = [
    "catalog",
    "catalog_size",
    "check_grain",
    "compare_metrics",
    "filter_fact",
    "filter_members",
    "filter_year",
    "has_any",
    "join_dimension",
    "lower_wins",
    "map_cells",
    "map_columns",
    "members_exist",
    "page",
    "page_after",
    "pick",
    "pivot_map",
    "query",
    "resolve_fields",
    "row_count",
    "search_prefix",
    "top_k_per_group",
]
