"""Run a query on Spark and its SQL on DuckDB and compare the rows exactly."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs first."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = _rows([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"{len(bad)} of {len(got[1])} rows differ, columns {got[0]}, first {bad[0]}"
    types = [tuple(type(v) for v in r if v is not None) for r in (got[1][:1] + want[1][:1])]
    return None if len(set(types)) <= 1 else f"types {types}"
