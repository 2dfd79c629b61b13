"""Registry of named queries and their SQL oracles.

A query is a callable ``(spark, sf_dir) -> DataFrame`` over the driver tables;
its oracle (when the operation is expressible in SQL) is a DuckDB query over
the same tables registered as views.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
