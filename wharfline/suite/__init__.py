"""The registered queries and their cross-check SQL, grouped by topic."""

from __future__ import annotations

from wharfline.suite import analytics, checks, cleaning, profiling, tables

_TOPICS = (analytics, tables, cleaning, checks, profiling)

QUERIES = {name: query for topic in _TOPICS for name, query in topic.QUERIES.items()}
ORACLE = {name: sql for topic in _TOPICS for name, sql in topic.ORACLE.items()}
