"""All registered queries."""

from . import keyword_queries, line_queries, payload_queries, report_queries, source_queries, text_queries, topic_queries
from .base import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "keyword_queries",
    "line_queries",
    "payload_queries",
    "report_queries",
    "source_queries",
    "text_queries",
    "topic_queries",
]
