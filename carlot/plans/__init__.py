"""Bindings of the operators to the benchmark tables, with their DuckDB oracle SQL.

``registry()`` maps a query name to ``(callable(spark, sf_dir) -> DataFrame, sql or None)``.
"""

from __future__ import annotations


def registry() -> dict:
    from carlot.plans import (catalog_queries, extract_queries, ingest_queries, load_queries, resolve_queries,
                              scalar_queries, scan_queries, store_queries)
    out: dict = {}
    for mod in (scalar_queries, store_queries, resolve_queries, extract_queries, ingest_queries, catalog_queries,
                load_queries, scan_queries):
        out.update(mod.QUERIES)
    return out
