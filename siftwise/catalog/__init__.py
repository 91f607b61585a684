"""Queries over the test tables, one per inventory id, and equivalent SQL."""

from siftwise.catalog import filters, graph, joins, keyed, reshapes, scalars, searches, services, sources, updates, vectors  # noqa: F401
from siftwise.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
