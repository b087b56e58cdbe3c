"""Registry pairing each Spark query with its DuckDB oracle SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the equivalent DuckDB query (None for model / non-SQL outputs)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
