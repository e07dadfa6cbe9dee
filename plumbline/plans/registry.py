"""All queries for the engine's own operators, and DuckDB SQL for them."""

from __future__ import annotations

from . import boundary_queries, catalog_queries, image_queries, profile_queries

_MODULES = (catalog_queries, profile_queries, image_queries, boundary_queries)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}
