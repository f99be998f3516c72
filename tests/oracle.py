"""Runs a registered query on Spark and its SQL on DuckDB and compares the two results."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _plain(x)) for k, x in v.items())
    return v


def _kind(v):
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con, sql: str):
    table = con.sql(sql).to_arrow_table()
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted((tuple(_plain(v) for v in row) for row in zip(*columns)), key=repr)


def difference(got, con, sql: str) -> str | None:
    """None if the rows of :func:`spark_rows` equal those of the SQL, else what differs first."""
    names, rows = got
    d_names, d_rows = duck_rows(con, sql)
    if names != d_names:
        return f"columns {names} against {d_names}"
    if len(rows) != len(d_rows):
        only = [r for r in rows if r not in set(d_rows)][:2] if len(rows) < 5000 else []
        missing = [r for r in d_rows if r not in set(rows)][:2] if len(rows) < 5000 else []
        return f"{len(rows)} rows against {len(d_rows)}; only spark {only}; only sql {missing}"
    for a, b in zip(rows, d_rows):
        if a != b:
            return f"{names}: {a} against {b}"
        if [_kind(x) for x in a] != [_kind(x) for x in b]:
            return f"types {[_kind(x) for x in a]} against {[_kind(x) for x in b]}"
    return None
