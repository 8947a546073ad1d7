"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.7g}") + 0.0
    if hasattr(v, "asDict"):
        v = list(v)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    a = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    b = sorted((tuple(plain(r[i]) for i in at) for r in want), key=repr)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-6 * max(1, abs(p), abs(q))) for p, q in zip(x, y, strict=True)), (x, y)
