"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from . import detail_queries, evidence_queries, file_queries, flag_queries, session_queries

PARTS = (session_queries, evidence_queries, flag_queries, detail_queries, file_queries)


def queries() -> dict:
    return {name: query for part in PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
