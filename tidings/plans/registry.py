"""Query registry: name → (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
test tables; the SQL twin is an independent DuckDB formulation of the same
result over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module so their queries register."""
    from . import catalog_sources, catalog_text, catalog_clusters, catalog_features, catalog_events, catalog_vectors, catalog_merge, catalog_stream, catalog_dates, catalog_annotate, catalog_small  # noqa: F401
