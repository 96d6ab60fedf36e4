"""Comparison of a query with its SQL in a second engine, rows as bags."""

from __future__ import annotations

from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def engine(folder: str):
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def same_rows(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    rel = con.sql(sql)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    theirs = sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=key)
    assert ours == theirs
