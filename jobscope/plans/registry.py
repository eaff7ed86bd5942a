"""Registry of named queries: a Spark builder plus, where SQL can state it, DuckDB oracle text.

``register(name, sql=..., views=...)`` decorates ``fn(spark, sf_dir) -> DataFrame``.
``views`` lists the fixture views the oracle SQL needs; they are inlined as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from jobscope.sources.fixtures import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql.strip()
        return fn
    return deco
