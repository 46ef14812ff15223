"""Runnable queries over the given tables, each with its oracle SQL where SQL can say it."""

from corpusloom.catalog.base import ORACLES, QUERIES
from corpusloom.catalog import (  # noqa: F401  (importing registers the queries)
    join_queries,
    plan_queries,
    report_queries,
    score_queries,
    source_queries,
    text_queries,
    vector_queries,
)

__all__ = ["ORACLES", "QUERIES"]
