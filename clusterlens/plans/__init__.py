"""Registered queries (one per operator key of the blueprint) and their DuckDB oracle twins."""

from . import jobs_queries, metric_queries, parse_queries, queue_queries, report_queries, source_queries, text_queries  # noqa: F401  (registers on import)
from .registry import ORACLE, QUERIES, query

__all__ = ["ORACLE", "QUERIES", "query"]
