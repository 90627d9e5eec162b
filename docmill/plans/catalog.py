"""All queries of the core and their SQL."""

from __future__ import annotations

from docmill.plans import changes, retrieval_queries
from docmill.plans.retrieval_queries import flagship

__all__ = ["QUERIES", "SQL", "flagship"]
QUERIES = {**changes.QUERIES, **retrieval_queries.QUERIES}
SQL = {**changes.SQL, **retrieval_queries.SQL}
