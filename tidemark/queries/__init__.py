"""Registered queries; importing this package fills the registry."""

from tidemark.queries import records, searching, windowing, zoning  # noqa: F401
from tidemark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
