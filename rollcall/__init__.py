"""rollcall: attendance analytics as lazy Spark DataFrame operators.

    from rollcall import absence, read_fact, stage_fact, reports
    fact = stage_fact(spark, absence(spark, "/data/star"))   # or read_fact(spark, path)
    reports.region_chart(fact)["trends"].show()
"""

from .plans import reports
from .sources import absence, load_fact, read_fact, read_fact_csv, stage_fact, write_fact

__version__ = "0.1.0"

__all__ = ["absence", "load_fact", "read_fact", "read_fact_csv", "reports", "stage_fact", "write_fact"]
