"""All registered queries."""

from . import collection_queries, search_queries, vector_queries, write_queries
from .registry import PLANS, SQL

__all__ = ["PLANS", "SQL", "collection_queries", "search_queries", "vector_queries", "write_queries"]
