"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NA or value != value:
        return "<null>"
    return repr(float(value)) if isinstance(value, (bool, int)) else str(value)


def normal_form(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        kind = df[name].dtype
        if str(kind).startswith("datetime64"):
            df[name] = df[name].astype("datetime64[us]").astype(str)
        elif kind == object or str(kind) in ("str", "string"):
            df[name] = df[name].map(_text)
        else:
            df[name] = df[name].astype(float).map(lambda v: "<null>" if v != v else repr(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    a, b = normal_form(got), normal_form(want)
    for name in a.columns:
        wrong = (a[name] != b[name]).to_numpy().nonzero()[0]
        if len(wrong):
            i = wrong[0]
            return f"{name}: {len(wrong)} differ, first {a.loc[i].to_dict()} against {b.loc[i].to_dict()}"
    return None
