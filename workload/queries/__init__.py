"""Every operator as a named query over the test tables, with its SQL twin.

``@run(sql)`` registers a function under its own name. Doubles that come out
of arithmetic are rounded to 6 digits on both sides.
"""

from workload.queries import (  # noqa: F401
    bars,
    cleaning,
    ingest,
    labels,
    model,
    ordering,
    quality_tables,
    reports,
    streams,
)
from workload.queries.shared import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
