"""Order-blind comparison of a DataFrame with a SQL result over the same Parquet folder."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _row_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_row_key)


def expected(connection, sql: str):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), rows_of(names, cursor.fetchall())


def actual(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None. Values must be equal to the last bit."""
    names, rows = actual(df)
    want_names, want_rows = expected(connection, sql)
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows instead of {len(want_rows)}"
    wrong = [(a, b) for a, b in zip(rows, want_rows, strict=True) if a != b]
    return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}" if wrong else None
