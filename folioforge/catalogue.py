"""All queries of the engine's own operators, and their SQL."""

from __future__ import annotations

from .plans import join_queries, more_queries, quality_queries, record_queries, stat_queries, text_queries  # noqa: F401
from .plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
