"""Compares a query with its SQL on DuckDB: rows, columns, values."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def oracle(sql: str, sf_dir: str) -> pd.DataFrame:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection.execute(sql).df()


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if hasattr(x, "tolist"):
            x = x.tolist()
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return "null"
        if isinstance(x, (list, tuple)):
            return str([plain(y) for y in x])
        if isinstance(x, bool):
            return str(int(x))
        if isinstance(x, (int, float)):
            return f"{float(x):.9g}"
        return str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(x) for x in row) for row in frame.itertuples(index=False, name=None))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if a == b:
        return ""
    only = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
    return f"{len(a)} and {len(b)} rows; only here {only[0]}; only in SQL {only[1]}"
