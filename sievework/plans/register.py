"""Registration of queries: a name, a function of (spark, sf_dir) and the SQL for it, if any."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add
