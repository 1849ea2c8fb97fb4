"""The registered queries: each operator on the test tables, next to the SQL it must match."""

from tidegate_queries import checks, codecs, files, jobs, late, streams  # noqa: F401
from tidegate_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
