"""Report plans composed from the operators: places, comparison, regions,
school type x region links and the chart tables."""

from . import charts, comparison, links, places, regions, reports

__all__ = ["charts", "comparison", "links", "places", "regions", "reports"]
