"""All named queries."""

from larder.registry import batch_checks, capture, feeds, ingest, revenue, star, transforms  # noqa: F401
from larder.registry.base import QUERIES, comparable

__all__ = ["QUERIES", "comparable"]
