"""Run a query's SQL in DuckDB and compare rows regardless of order."""

from __future__ import annotations

import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def plain(v: object) -> object:
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def assert_same(df, sql: str, sf_dir: str) -> None:
    got = duck(sf_dir).execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())
