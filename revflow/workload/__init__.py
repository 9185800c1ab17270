"""Queries over the given tables, each with the SQL that must agree with it."""

from revflow.workload import (  # noqa: F401  (each module registers its queries)
    files,
    flow,
    ledgers,
    mart_queries,
    scalars,
    shaping,
    stores,
    tables,
)
from revflow.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
