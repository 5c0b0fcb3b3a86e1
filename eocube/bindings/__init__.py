"""Every operator as a query over the given tables, with its check in SQL."""

from eocube.bindings import (  # noqa: F401  (importing registers the queries)
    aggregates,
    functions,
    joins,
    ordered,
    projections,
    scans,
    streams,
    whole,
)
from eocube.bindings.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
