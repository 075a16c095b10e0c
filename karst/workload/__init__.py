"""Registered queries: each runs one operator over whole tables, next to the
SQL that must give the same rows."""

from karst.workload.registry import ORACLES, QUERIES
from karst.workload import imports, indexes, mutations, predicates, search, tables, batches  # noqa: F401  (register)

__all__ = ["QUERIES", "ORACLES"]
