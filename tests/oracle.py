"""Compares registered queries with their DuckDB SQL on the same parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, list | tuple):
        return tuple(map(_plain, value))
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else what differs."""
    found = db.sql(sql)
    if sorted(df.columns) != sorted(found.columns):
        return f"columns {sorted(df.columns)} and {sorted(found.columns)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(found.columns, found.fetchall())
    if a != b:
        return f"{len(a)} and {len(b)} rows; " + str([(x, y) for x, y in zip(a, b, strict=False) if x != y][:1])[:600]
    return ""
