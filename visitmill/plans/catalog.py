"""All registered queries."""

from visitmill.plans import queries_jobs, queries_mapping, queries_rows, queries_sources  # noqa: F401
from visitmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
