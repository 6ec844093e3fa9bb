"""Comparing a DataFrame with the SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

DATA = "/root/testdata/sf0.001"


def tables(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(x):
    if hasattr(x, "tolist") and not isinstance(x, (str, bytes)):
        x = x.tolist()
    if isinstance(x, list):
        return str([_plain(v) for v in x])
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
        return "null"
    if isinstance(x, float):
        return str(int(x)) if x == int(x) else repr(round(x, 9))
    return str(x)


def rows(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(_plain, r)) for r in df.itertuples(index=False))


def same(left: pd.DataFrame, right: pd.DataFrame) -> None:
    (a, x), (b, y) = rows(left), rows(right)
    assert a == b
    assert len(x) == len(y)
    assert x == y
