"""Rows of a DataFrame and of a SQL query in one comparable form."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [_value(x) for x in v]
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows(df, order: list[str] | None = None) -> list[str]:
    names = order or sorted(df.columns)
    return sorted(repr([_value(r[c]) for c in names]) for r in df.collect())


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[str]]:
    """(sorted column names, rows)."""
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = c.execute(sql)
    names = [x[0] for x in got.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr([_value(r[i]) for i in at]) for r in got.fetchall())
