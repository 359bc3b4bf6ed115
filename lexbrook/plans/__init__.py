"""Queries over the driver's tables, registered by family."""

from . import registry  # noqa: F401  isort: skip
from . import date_queries, dedup_queries, document_queries, graph_queries, relational_queries, resolve_queries, search_queries, source_queries, state_queries, stats_queries, text_queries, traffic_queries  # noqa: F401
