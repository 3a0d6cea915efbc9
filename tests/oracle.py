"""Compares a Spark result with DuckDB's on the same tables: columns, types and all values."""

from __future__ import annotations

import datetime as dt
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted(rows):
    return sorted([tuple(_plain(v) for v in r) for r in rows], key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def mismatch(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = [str(d[1]) for d in rel.description]
    theirs = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    wanted = {n: TYPES.get(t.upper(), t) for n, t in zip(names, types)}
    for n in order:
        have = df.schema[n].dataType.simpleString()
        if have != wanted[n]:
            return f"type of {n}: {have} != {wanted[n]}"
    ours = _sorted(df.select(*order).collect())
    pick = [names.index(n) for n in order]
    theirs = _sorted([tuple(r[i] for i in pick) for r in theirs])
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
