"""Queries of the catalog operators over the whole tables, and their SQL."""

from __future__ import annotations

from folioforge.plans import layout_queries, quality_queries, record_queries, table_queries

_PARTS = (record_queries, layout_queries, table_queries, quality_queries)


def queries():
    return {name: f for part in _PARTS for name, f in part.queries().items()}


def oracle_sql():
    return {name: sql for part in _PARTS for name, sql in part.oracle_sql().items()}
